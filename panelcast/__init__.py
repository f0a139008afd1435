"""Weekly panel analytics, forecasting and evaluation on Spark."""
__version__ = "0.1.0"
