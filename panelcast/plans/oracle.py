"""Oracle SQL (DuckDB dialect) for the named queries, written independently of the
Spark plans: the panel, features, metrics and reports are spelled out as SQL
over the raw tables with window functions, joins and aggregates."""
from __future__ import annotations

import math

from .. import config as C
from ..functions.calendar import rule_calendar
from ..operators import forecast as fc
from ..sources.star import panel_sql
from .queries import VARIANTS

VS = C.VALIDATION_START
W = "PARTITION BY Store ORDER BY Date"
MODELS = list(fc.BASELINES)
METRICS = ("WMAPE", "MAPE", "SMAPE", "MAE", "RMSE", "R2", "Mean_Error", "Median_AE")


def _hol_values() -> str:
    cal = rule_calendar(range(1990, 2013))
    rows = ", ".join(f"('{n}', DATE '{d.isoformat()}')" for n in C.HOLIDAY_NAMES for d in cal[n])
    return f"SELECT * FROM (VALUES {rows}) AS v(holiday, h)"


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} AS ({s})" for n, s in ctes)
    return f"WITH {body}\n{final}"


def exact_mean(col: str, frame: str = "") -> str:
    over = f" OVER ({frame})" if frame else ""
    return (f"CAST(sum(CAST({col} AS DECIMAL(18,4))){over} AS DOUBLE) / "
            f"CAST(count({col}){over} AS DOUBLE)")


BASE = [("panel", panel_sql()), ("hol", _hol_values())]

TEMPORAL = """
  CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
  CAST(weekofyear(Date) AS INTEGER) AS week_of_year, CAST(dayofyear(Date) AS INTEGER) AS day_of_year,
  CAST(quarter(Date) AS INTEGER) AS quarter, CAST((day(Date) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
  CAST(day(Date) <= 7 AS INTEGER) AS is_month_start, CAST(day(Date) >= 24 AS INTEGER) AS is_month_end,
  CAST(month(Date) IN (1, 4, 7, 10) AND day(Date) <= 7 AS INTEGER) AS is_quarter_start,
  CAST(month(Date) IN (3, 6, 9, 12) AND day(Date) >= 24 AS INTEGER) AS is_quarter_end,
  CAST(month(Date) = 1 AND day(Date) <= 7 AS INTEGER) AS is_year_start,
  CAST(month(Date) = 12 AND day(Date) >= 24 AS INTEGER) AS is_year_end"""


def cyclical(digits: int = 6) -> str:
    parts = []
    for prefix, src, period in (("month", "month", 12), ("week", "week_of_year", 52),
                                ("day_of_year", "day_of_year", 365), ("quarter", "quarter", 4)):
        k = repr(2 * math.pi / period)
        parts.append(f"round(sin({src} * {k}), {digits}) AS {prefix}_sin")
        parts.append(f"round(cos({src} * {k}), {digits}) AS {prefix}_cos")
    return ", ".join(parts)


def _exists(cond: str) -> str:
    return f"CAST(EXISTS (SELECT 1 FROM hol WHERE {cond}) AS INTEGER)"


HOLIDAY_FLAGS = ", ".join(
    [f"{_exists(f'hol.holiday = {chr(39)}{n}{chr(39)} AND abs(Date - hol.h) <= 3')} AS is_{n.lower()}"
     for n in C.HOLIDAY_NAMES]
    + [f"{_exists('hol.holiday = ' + chr(39) + 'Thanksgiving' + chr(39) + ' AND Date >= hol.h - 14 AND Date < hol.h - 3')} AS is_pre_thanksgiving",
       f"{_exists('hol.holiday = ' + chr(39) + 'Christmas' + chr(39) + ' AND Date >= hol.h - 28 AND Date < hol.h - 3')} AS is_pre_christmas",
       f"{_exists('hol.holiday = ' + chr(39) + 'Thanksgiving' + chr(39) + ' AND Date > hol.h AND Date <= hol.h + 7')} AS is_black_friday_week"])

HOLIDAY_DIST = """
  CAST(COALESCE((SELECT min(hol.h - Date) FROM hol WHERE hol.h >= Date), 52) // 7 AS INTEGER) AS weeks_to_next_holiday,
  CAST(COALESCE((SELECT min(Date - hol.h) FROM hol WHERE hol.h <= Date), 52) // 7 AS INTEGER) AS weeks_since_last_holiday"""

LAGS = ", ".join(f"lag(Weekly_Sales, {k}) OVER ({W}) AS sales_lag_{k}" for k in C.LAGS)
SWLY = ("lag(Weekly_Sales, 1) OVER (PARTITION BY Store, week_of_year ORDER BY Date) "
        "AS sales_same_week_last_year")


def rolling(windows=C.ROLLING_WINDOWS) -> str:
    parts = []
    for k in windows:
        fr = f"{W} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING"
        parts.append(f"{exact_mean('Weekly_Sales', fr)} AS rolling_mean_{k}w")
        parts.append(f"stddev_samp(Weekly_Sales) OVER ({fr}) AS rolling_std_{k}w")
        if k <= C.MINMAX_MAX_WINDOW:
            parts.append(f"min(Weekly_Sales) OVER ({fr}) AS rolling_min_{k}w")
            parts.append(f"max(Weekly_Sales) OVER ({fr}) AS rolling_max_{k}w")
    return ", ".join(parts)


def ewma_ctes(src: str = "panel") -> list[tuple[str, str]]:
    """Every earlier row of the series weighs in (unbounded self join)."""
    cols = []
    for s in C.EWMA_SPANS:
        wexpr = f"pow({1.0 - 2.0 / (s + 1.0)!r}, a.rn - 1 - b.rn)"
        cols.append(f"sum(b.Weekly_Sales * {wexpr}) / sum(CASE WHEN b.Weekly_Sales IS NOT NULL THEN {wexpr} END) "
                    f"AS ewma_{s}w")
    return [("ewrn", f"SELECT Store, Date, Weekly_Sales, row_number() OVER ({W}) AS rn FROM {src}"),
            ("ew", f"""SELECT a.Store, a.Date, {', '.join(cols)}
                       FROM ewrn a JOIN ewrn b ON a.Store = b.Store AND b.rn < a.rn
                       GROUP BY a.Store, a.Date""")]


def long_series_sql() -> dict[str, str]:
    """History features of orders, one series a status."""
    def orders(text: str) -> str:
        text = text.replace("Weekly_Sales", "o_totalprice").replace("Store", "o_orderstatus")
        return text.replace("ORDER BY Date", "ORDER BY o_orderdate, o_orderkey")
    keys = "o_orderstatus, o_orderdate, o_orderkey, o_totalprice"
    std = ", ".join(f"round(rolling_std_{k}w, 2) AS rolling_std_{k}w" for k in C.ROLLING_WINDOWS)
    ewma = []
    for s in C.EWMA_SPANS:
        weight = f"pow({1.0 - 2.0 / (s + 1.0)!r}, a.rn - 1 - b.rn)"
        ewma.append(f"round(sum(b.o_totalprice * {weight}) / "
                    f"sum(CASE WHEN b.o_totalprice IS NOT NULL THEN {weight} END), 3) AS ewma_{s}w")
    return {
        "lag_features_long": f"SELECT {keys}, {orders(LAGS)} FROM orders",
        "rolling_features_long": f"SELECT * REPLACE ({std}) FROM (SELECT {keys}, {orders(rolling())} FROM orders) r",
        "ewma_features_long": f"""WITH o AS (SELECT {keys}, row_number() OVER ({orders(W)}) AS rn FROM orders)
            SELECT a.o_orderstatus, a.o_orderdate, a.o_orderkey, a.o_totalprice, {', '.join(ewma)}
            FROM o a LEFT JOIN o b ON a.o_orderstatus = b.o_orderstatus AND b.rn < a.rn GROUP BY 1, 2, 3, 4""",
    }


def pct(cur: str, prev: str) -> str:
    return f"CASE WHEN {prev} = 0 THEN NULL ELSE {cur} / {prev} - 1 END"


TREND = (f"Weekly_Sales - lag(Weekly_Sales, 1) OVER ({W}) AS sales_diff_1, "
         f"Weekly_Sales - lag(Weekly_Sales, 4) OVER ({W}) AS sales_diff_4, "
         f"{pct('Weekly_Sales', f'lag(Weekly_Sales, 1) OVER ({W})')} AS sales_pct_change_1, "
         f"{pct('Weekly_Sales', f'lag(Weekly_Sales, 4) OVER ({W})')} AS sales_pct_change_4, "
         "CAST(COALESCE(Weekly_Sales > rolling_mean_4w, false) AS INTEGER) AS above_rolling_mean_4w, "
         "(Weekly_Sales - rolling_mean_4w) / (rolling_std_4w + 1.0) AS trend_strength")

INTERACT = ("Store * Holiday_Flag AS store_holiday, Store * month AS store_month, "
            "Temperature * quarter AS temp_quarter")


def store_ctes(train_src: str = "panel", train_filter: str = f"Date < DATE '{VS}'") -> list[tuple[str, str]]:
    return [
        ("st0", f"""SELECT Store, {exact_mean('Weekly_Sales')} AS store_mean_sales,
                    stddev_samp(Weekly_Sales) AS store_std_sales, min(Weekly_Sales) AS store_min_sales,
                    max(Weekly_Sales) AS store_max_sales, median(Weekly_Sales) AS store_median_sales
                    FROM {train_src} WHERE {train_filter} GROUP BY Store"""),
        ("st1", """SELECT *,
                   CASE WHEN store_mean_sales IS NOT NULL THEN
                     CAST(rank() OVER (ORDER BY store_mean_sales DESC NULLS LAST) AS DOUBLE)
                     + (count(*) OVER (PARTITION BY store_mean_sales) - 1) / 2.0 END AS store_rank,
                   CASE WHEN store_mean_sales IS NOT NULL THEN
                     (rank() OVER (ORDER BY store_mean_sales ASC NULLS LAST)
                     + (count(*) OVER (PARTITION BY store_mean_sales) - 1) / 2.0)
                     / count(store_mean_sales) OVER () END AS store_percentile,
                   store_std_sales / store_mean_sales AS store_cv
                   FROM st0"""),
        ("st", """SELECT Store, store_mean_sales, store_std_sales, store_min_sales, store_max_sales,
                  store_median_sales, store_rank, store_percentile, store_cv,
                  CASE WHEN store_mean_sales IS NULL THEN NULL WHEN mx = mn THEN 'medium'
                       WHEN store_mean_sales <= mn + (mx - mn) / 3.0 THEN 'small'
                       WHEN store_mean_sales <= mn + 2 * ((mx - mn) / 3.0) THEN 'medium'
                       ELSE 'large' END AS store_size
                  FROM st1, (SELECT min(store_mean_sales) AS mn, max(store_mean_sales) AS mx FROM st0) b"""),
    ]


ST_ROUND = ("Store, store_mean_sales, round(store_std_sales, 2) AS store_std_sales, store_min_sales, "
            "store_max_sales, round(store_median_sales, 6) AS store_median_sales, store_rank, "
            "store_percentile, round(store_cv, 8) AS store_cv, store_size")


def train_scalars(src: str = "panel") -> tuple[str, str]:
    return ("ts", f"""SELECT avg(Temperature) AS temp_mean, stddev_samp(Temperature) AS temp_std,
                      avg(Unemployment) AS unemp_mean FROM {src} WHERE Date < DATE '{VS}'""")


def economic(part: str) -> str:
    wp = f"PARTITION BY {part} ORDER BY Date"
    return f"""
  (Temperature - ts.temp_mean) / ts.temp_std AS temp_deviation,
  Temperature * Temperature AS temp_squared,
  CASE WHEN Temperature IS NULL THEN NULL WHEN Temperature <= 32 THEN 'freezing'
       WHEN Temperature <= 50 THEN 'cold' WHEN Temperature <= 70 THEN 'mild'
       WHEN Temperature <= 85 THEN 'warm' ELSE 'hot' END AS temp_category,
  Fuel_Price - lag(Fuel_Price) OVER ({wp}) AS fuel_change,
  {pct('Fuel_Price', f'lag(Fuel_Price) OVER ({wp})')} AS fuel_pct_change,
  CPI - lag(CPI) OVER ({wp}) AS cpi_change,
  {pct('CPI', f'lag(CPI) OVER ({wp})')} AS cpi_pct_change,
  Unemployment - lag(Unemployment) OVER ({wp}) AS unemployment_change,
  CAST(COALESCE(Unemployment > ts.unemp_mean, false) AS INTEGER) AS unemployment_above_avg,
  CPI / (Unemployment + 0.1) AS cpi_unemployment_ratio"""


SPLIT = f"CASE WHEN Date < DATE '{VS}' THEN 'train' WHEN Date >= DATE '{VS}' THEN 'validation' END AS split"

ROUND_COLS = {**{f"rolling_std_{k}w": 2 for k in C.ROLLING_WINDOWS},
              **{f"ewma_{s}w": 1 for s in C.EWMA_SPANS},
              "trend_strength": 6, "store_std_sales": 2, "store_cv": 8, "store_median_sales": 6,
              "temp_deviation": 6}


def rounded_star(src: str) -> str:
    cols = ", ".join(f"round({c}, {d}) AS {c}" for c, d in ROUND_COLS.items())
    return f"SELECT * REPLACE ({cols}) FROM {src}"


def feature_ctes(split: bool) -> list[tuple[str, str]]:
    """History features on the full panel (f3), then store + economic stage."""
    ctes = list(BASE)
    ctes += [("f1", f"SELECT *, {TEMPORAL}, {HOLIDAY_FLAGS}, {HOLIDAY_DIST} FROM panel"),
             ("f1b", f"SELECT *, {cyclical()}, {LAGS}, {rolling()} FROM f1"),
             ("f2", f"SELECT *, {SWLY}, {TREND} FROM f1b")]
    ctes += ewma_ctes()
    ctes += [("f3", f"SELECT f2.*, ew.ewma_4w, ew.ewma_8w, ew.ewma_12w, {INTERACT} "
                    f"FROM f2 LEFT JOIN ew USING (Store, Date)")]
    ctes += store_ctes()
    ctes.append(train_scalars())
    part = "split, Store" if split else "Store"
    sp = f", {SPLIT}" if split else ""
    ctes += [("f4", f"SELECT f3.*{sp} FROM f3"),
             ("f5", f"SELECT f4.*, st.* EXCLUDE (Store), {economic(part)} "
                    f"FROM f4 LEFT JOIN st USING (Store), ts")]
    return ctes


def featured_sql(split: bool = True) -> str:
    return _with(feature_ctes(split), rounded_star("f5"))


# ------------------------------------------------------------- predictions
def baseline_ctes() -> list[tuple[str, str]]:
    ma = exact_mean("Weekly_Sales", f"{W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING")
    return list(BASE) + [
        ("bw0", f"""SELECT *, lag(Weekly_Sales, 1) OVER ({W}) AS naive_Pred,
                    lag(Weekly_Sales, 52) OVER ({W}) AS seasonal_naive_Pred,
                    {ma} AS moving_average_4w_Pred FROM panel"""),
        ("bw", f"""SELECT * FROM bw0 WHERE Date >= DATE '{VS}' AND naive_Pred IS NOT NULL
                   AND seasonal_naive_Pred IS NOT NULL AND moving_average_4w_Pred IS NOT NULL"""),
        ("bl", " UNION ALL ".join(
            f"SELECT Store, Date, Weekly_Sales AS actual, Holiday_Flag, '{m}' AS model, {m}_Pred AS pred FROM bw"
            for m in MODELS)),
    ]


def metric_exprs(digits: int | None = 6) -> dict[str, str]:
    e = {
        "WMAPE": "sum(abs(actual - pred)) / NULLIF(sum(CASE WHEN pred IS NOT NULL THEN actual END), 0) * 100",
        "MAPE": "avg(CASE WHEN actual <> 0 THEN abs((actual - pred) / actual) END) * 100",
        "SMAPE": ("CASE WHEN count(actual - pred) > 0 THEN COALESCE(avg(CASE WHEN abs(actual) + abs(pred) <> 0 "
                  "THEN 2 * abs(actual - pred) / (abs(actual) + abs(pred)) END) * 100, 0.0) END"),
        "MAE": "avg(abs(actual - pred))",
        "RMSE": "sqrt(avg(pow(actual - pred, 2)))",
        "R2": ("1 - sum(pow(actual - pred, 2)) / NULLIF(var_pop(CASE WHEN pred IS NOT NULL THEN actual END) "
               "* count(CASE WHEN pred IS NOT NULL THEN actual END), 0)"),
        "Mean_Error": "avg(pred - actual)",
        "Median_AE": "median(abs(actual - pred))",
    }
    if digits is None:
        return e
    return {k: f"round({v}, {digits + 2 if k == 'R2' else digits})" for k, v in e.items()}


def metrics_select(digits: int | None = 6) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in metric_exprs(digits).items())


def with_baseline(final: str, extra: list[tuple[str, str]] | None = None) -> str:
    return _with(baseline_ctes() + (extra or []), final)


METRICS_CTE = ("bm", f"SELECT model, {metrics_select()} FROM bl GROUP BY model")


def hist_bins(src: str, value: str, by: str | None, bins: int = C.HISTOGRAM_BINS) -> str:
    """All bins of each group, empty ones too; null values are in none."""
    key, join = (f"{by}, ", f"USING ({by}, bin)") if by else ("", "USING (bin)")
    group = f"GROUP BY {by}" if by else ""
    match = f"USING ({by})" if by else "ON true"
    return f"""SELECT {key}bin, lo + bin * w AS bin_start, lo + (bin + 1) * w AS bin_end, coalesce(n, 0) AS count
               FROM (SELECT {key}lo, (hi - lo) / {bins} AS w, CAST(range AS INTEGER) AS bin
                     FROM (SELECT {key}min({value}) AS lo, max({value}) AS hi FROM {src}
                           WHERE {value} IS NOT NULL {group}) r, range({bins})) a
               LEFT JOIN (SELECT {key}bin, count(*) AS n
                          FROM (SELECT {key}CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor(({value} - lo)
                                       / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER) AS bin
                                FROM {src} x JOIN (SELECT {key}min({value}) AS lo, max({value}) AS hi
                                                   FROM {src} {group}) r {match}
                                WHERE {value} IS NOT NULL) t GROUP BY {key}bin) b {join}"""


def ensemble_sql(final_predict: bool) -> str:
    models = sorted(MODELS)

    def blend(scale: str) -> str:
        terms = [f"(CAST(g.w{i} AS DOUBLE) / {scale}) * {m}_Pred" for i, m in enumerate(models)]
        out = terms[0]
        for t in terms[1:]:
            out = f"({out} + {t})"
        return out

    wcols = ", ".join(f"g.w{i}" for i in range(len(models)))
    ctes = [
        # every point of the 1/100 lattice on the simplex
        ("g2", """SELECT r0.range AS w0, r1.range AS w1, 100 - r0.range - r1.range AS w2
                  FROM range(0, 101) r0, range(0, 101) r1 WHERE r0.range + r1.range <= 100"""),
        ("e2", f"SELECT {wcols}, sum(abs(Weekly_Sales - {blend('100.0')})) AS err FROM bw, g2 g GROUP BY {wcols}"),
        ("b2", "SELECT * FROM e2 ORDER BY err, w0, w1, w2 LIMIT 1"),
        ("wt", " UNION ALL ".join(f"SELECT '{m}' AS model, CAST(w{i} AS DOUBLE) / 100.0 AS weight FROM b2"
                                  for i, m in enumerate(models))),
    ]
    if not final_predict:
        return with_baseline("SELECT model, weight FROM wt", ctes)
    terms = [f"(CAST(b2.w{i} AS DOUBLE) / 100.0) * {m}_Pred" for i, m in enumerate(models)]
    blend_expr = terms[0]
    for t in terms[1:]:
        blend_expr = f"({blend_expr} + {t})"
    return with_baseline(f"SELECT Store, Date, Weekly_Sales AS actual, {blend_expr} AS pred FROM bw, b2",
                         ctes)


def history_ctes() -> list[tuple[str, str]]:
    cum = "PARTITION BY model ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return [("ep", "SELECT Date, CAST(row_number() OVER (ORDER BY Date) - 1 AS INTEGER) AS epoch "
                   "FROM (SELECT DISTINCT Date FROM bl) d"),
            ("per", "SELECT model, epoch, sum(abs(actual - pred)) AS abs_err, sum(actual) AS act "
                    "FROM bl JOIN ep USING (Date) GROUP BY model, epoch"),
            ("hi", f"""SELECT model, epoch,
                       round(sum(abs_err) OVER ({cum}) / sum(act) OVER ({cum}) * 100, 6) AS train_WMAPE,
                       round(abs_err / act * 100, 6) AS val_WMAPE FROM per""")]


def rolling_origin_ctes(folds: int = 4, horizon: int = 10) -> list[tuple[str, str]]:
    """ro: baseline forecasts of each fold, every fold cut out by dates of its own."""
    names = ("naive", "seasonal_naive", "train_mean")
    return [
        ("pe", "SELECT Date, row_number() OVER (ORDER BY Date DESC) AS back FROM (SELECT DISTINCT Date FROM panel)"),
        ("fo", f"SELECT CAST(k AS INTEGER) AS fold, (SELECT min(Date) FROM pe WHERE back <= ({folds} - k + 1) * {horizon}) AS d0, "
               f"(SELECT max(Date) FROM pe WHERE back > ({folds} - k) * {horizon}) AS d1 FROM range(1, {folds + 1}) t(k)"),
        ("tr", f"SELECT fold, Store, arg_max(Weekly_Sales, Date) AS naive, {exact_mean('Weekly_Sales')} AS train_mean "
               "FROM panel JOIN fo ON Date < d0 GROUP BY fold, Store"),
        ("se", f"SELECT *, lag(Weekly_Sales, 52) OVER ({W}) AS seasonal_naive FROM panel"),
        ("te", "SELECT fo.fold, se.Store, se.Date, Weekly_Sales AS actual, seasonal_naive, naive, train_mean FROM se "
               "JOIN fo ON Date BETWEEN d0 AND d1 LEFT JOIN tr ON tr.fold = fo.fold AND tr.Store = se.Store"),
        ("ro", " UNION ALL ".join(f"SELECT fold, actual, '{m}' AS model, {m} AS pred FROM te WHERE {m} IS NOT NULL" for m in names))]


def trend_gram_ctes(knots: int = 25) -> list[tuple[str, str]]:
    """g2: a row for each term (k) of each training row."""
    fit = f"Date < DATE '{VS}' AND Weekly_Sales > 0"
    return [
        ("g0", f"SELECT Store, min(Date) AS d0, max(Date) AS d1 FROM panel WHERE {fit} GROUP BY Store"),
        ("g1", "SELECT panel.Store, Date, CAST(Date - d0 AS DOUBLE) / greatest(d1 - d0, 1) AS t, ln(Weekly_Sales) AS ly "
               f"FROM panel JOIN g0 ON panel.Store = g0.Store WHERE {fit}"),
        ("g2", "SELECT Store, Date, k, CASE WHEN k = 0 THEN CAST(1 AS DOUBLE) WHEN k = 1 THEN t "
               f"WHEN k <= {knots + 1} THEN greatest(t - CAST(0.8 AS DOUBLE) * (k - 1) / {knots}, 0) ELSE ly END AS v "
               f"FROM g1, range({knots + 3}) r(k)")]


def seasonal_ar_sql() -> str:
    ctes = list(BASE) + [
        ("a0", f"SELECT *, {SPLIT}, lag(Weekly_Sales, 52) OVER ({W}) AS y_season FROM panel"),
        ("a1", "SELECT *, Weekly_Sales - y_season AS z FROM a0"),
        ("a2", f"SELECT *, lag(z, 1) OVER ({W}) AS z_prev FROM a1"),
        ("prm", f"""SELECT Store, sum(z * z_prev) / NULLIF(sum(z_prev * z_prev), 0) AS phi,
                    arg_max_null(z, Date) AS z_last, {exact_mean('Weekly_Sales')} AS train_mean
                    FROM a2 WHERE split = 'train' GROUP BY Store"""),
        ("va", f"SELECT *, row_number() OVER ({W}) AS h FROM a2 WHERE split = 'validation'"),
    ]
    return _with(ctes, """SELECT va.Store, va.Date, va.Weekly_Sales AS actual,
                          round(COALESCE(va.y_season + COALESCE(pow(prm.phi, va.h) * prm.z_last, 0.0), prm.train_mean), 2) AS pred
                          FROM va LEFT JOIN prm USING (Store)""")


def oracle_sql() -> dict[str, str]:
    P = lambda final, extra=None: _with(list(BASE) + (extra or []), final)
    B = with_baseline
    q: dict[str, str] = {}
    q["load_panel"] = P("SELECT * FROM panel")
    q["panel_order"] = P("SELECT * FROM panel ORDER BY Store, Date")
    q["write_predictions"] = B("SELECT Store, Date, Weekly_Sales, " + ", ".join(f"{m}_Pred" for m in MODELS) + " FROM bw")
    q["time_split"] = P(f"SELECT {SPLIT}, count(*) AS n_rows, min(Date) AS date_min, max(Date) AS date_max FROM panel GROUP BY 1")
    q["store_list"] = P("SELECT DISTINCT Store FROM panel ORDER BY Store")
    q["store_slice"] = P("SELECT * FROM panel WHERE Store = 1")
    q["series_frame"] = P("SELECT Store, Date AS ds, Weekly_Sales AS y, Temperature, Fuel_Price, CPI, Unemployment, Holiday_Flag FROM panel")
    q["drop_missing"] = _with(feature_ctes(True), f"SELECT * FROM ({rounded_star('f5')}) z WHERE COLUMNS(*) IS NOT NULL")
    lag_cols = [f"sales_lag_{k}" for k in C.LAGS]
    fills = ", ".join(f"round(COALESCE({c}, avg({c}) OVER (PARTITION BY Store)), 4) AS {c}" for c in lag_cols)
    q["fill_missing_store_mean"] = _with(feature_ctes(True), f"SELECT Store, Date, {fills}, round(COALESCE(rolling_std_4w, avg(rolling_std_4w) OVER (PARTITION BY Store)), 2) AS rolling_std_4w FROM f5")
    q["holiday_label"] = P("SELECT Store, Date, Holiday_Flag, CASE WHEN Holiday_Flag = 1 THEN 'Holiday' WHEN Holiday_Flag = 0 THEN 'Non-Holiday' END AS Holiday FROM panel")
    q["holidays_in_range"] = P("SELECT holiday, h AS date FROM hol WHERE h BETWEEN (SELECT min(Date) FROM panel) AND (SELECT max(Date) FROM panel)")
    q["select_model"] = B("SELECT * FROM bl WHERE model = 'naive'")
    raw = f"SELECT model, {metrics_select(None)} FROM bl GROUP BY model"
    q["metrics_report"] = B(f"""SELECT model AS Model, printf('%.2f%%', WMAPE) AS WMAPE,
        '$' || format('{{:,.0f}}', MAE) AS MAE, '$' || format('{{:,.0f}}', RMSE) AS RMSE,
        printf('%.4f', R2) AS R2 FROM ({raw}) m""")
    q["temporal_features"] = P(f"SELECT *, {TEMPORAL} FROM panel")
    q["cyclical_features"] = P(f"SELECT *, {cyclical()} FROM (SELECT *, {TEMPORAL} FROM panel) t")
    q["interaction_features"] = P(f"SELECT Store, Date, {INTERACT} FROM (SELECT *, {TEMPORAL} FROM panel) t")
    q["temperature_features"] = P("""SELECT Store, Date, Temperature, round((Temperature - ts.temp_mean) / ts.temp_std, 6) AS temp_deviation,
        Temperature * Temperature AS temp_squared,
        CASE WHEN Temperature IS NULL THEN NULL WHEN Temperature <= 32 THEN 'freezing' WHEN Temperature <= 50 THEN 'cold'
             WHEN Temperature <= 70 THEN 'mild' WHEN Temperature <= 85 THEN 'warm' ELSE 'hot' END AS temp_category
        FROM panel, ts""", [train_scalars()])
    q["unemployment_level"] = P("SELECT Store, Date, Unemployment, CAST(COALESCE(Unemployment > ts.unemp_mean, false) AS INTEGER) AS unemployment_above_avg FROM panel, ts", [train_scalars()])
    q["cpi_ratio"] = P("SELECT Store, Date, CPI / (Unemployment + 0.1) AS cpi_unemployment_ratio FROM panel")
    q["store_size_bins"] = P(f"SELECT {ST_ROUND} FROM st", store_ctes())
    q["month_labels"] = P("SELECT Store, Date, CAST(month(Date) AS INTEGER) AS Month, monthname(Date) AS Month_Name FROM panel")
    q["store_features"] = P(f"SELECT panel.*, {ST_ROUND.replace('Store, ', '', 1)} FROM panel LEFT JOIN st USING (Store)", store_ctes())
    q["holiday_window_flags"] = P(f"SELECT Store, Date, {HOLIDAY_FLAGS} FROM panel")
    q["holiday_window_flags_table"] = q["holiday_window_flags"]
    q["rolling_origin_metrics"] = P(
        "SELECT fold, model, " + ", ".join(f"round({m} + 1e-9, 6) AS {m}" for m in METRICS)
        + f" FROM (SELECT fold, model, {metrics_select(None)} FROM ro GROUP BY fold, model) m", rolling_origin_ctes())
    q["trend_gram"] = P("""SELECT a.Store, count(*) AS n, CAST(row_number() OVER (PARTITION BY a.Store ORDER BY a.k, b.k) - 1 AS INTEGER) AS place,
        round(sum(a.v * b.v), 5) AS total FROM g2 a JOIN g2 b ON a.Store = b.Store AND a.Date = b.Date AND a.k <= b.k
        GROUP BY a.Store, a.k, b.k""", trend_gram_ctes())
    q["holiday_distance"] = P(f"SELECT Store, Date, {HOLIDAY_DIST} FROM panel")
    q["holiday_distance_table"] = q["holiday_distance"]
    q["train_stat_scalars"] = P("SELECT Store, Date, round(temp_mean, 8) AS temp_mean, round(temp_std, 8) AS temp_std, round(unemp_mean, 8) AS unemp_mean FROM panel, ts", [train_scalars()])
    q["align_predictions"] = B("SELECT Store, Date, Weekly_Sales, " + ", ".join(f"{m}_Pred" for m in MODELS) + " FROM bw")
    q["validate_panel"] = P("""SELECT count(*) AS total_rows, count(DISTINCT Store) AS n_stores, count(DISTINCT Date) AS n_weeks,
        min(Date) AS date_min, max(Date) AS date_max, """ + ", ".join(
        f"count(*) - count({c}) AS missing_{c}" for c in C.PANEL_COLUMNS) + """,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM panel) d) AS duplicates,
        CAST(sum(CASE WHEN Weekly_Sales < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_sales,
        count(*) = count(DISTINCT Store) * count(DISTINCT Date) AS complete_coverage FROM panel""")
    q["panel_summary"] = P(f"""SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_cols, min(Date) AS date_start, max(Date) AS date_end,
        count(DISTINCT Date) AS n_weeks, count(DISTINCT Store) AS n_stores, {exact_mean('Weekly_Sales')} AS sales_mean,
        round(stddev_samp(Weekly_Sales), 2) AS sales_std, min(Weekly_Sales) AS sales_min, max(Weekly_Sales) AS sales_max,
        round(median(Weekly_Sales), 6) AS sales_median, CAST(sum(Holiday_Flag) AS BIGINT) AS holiday_count,
        round(avg(Holiday_Flag) * 100, 6) AS holiday_pct FROM panel""")
    q["store_stats"] = P("""SELECT Store, store_mean_sales, round(store_std_sales, 2) AS store_std_sales, store_min_sales, store_max_sales,
        round(store_median_sales, 6) AS store_median_sales, round(store_std_sales / store_mean_sales, 8) AS store_cv FROM st0""", store_ctes())
    q["sales_by_date"] = P(f"SELECT Date, {exact_mean('Weekly_Sales')} AS Weekly_Sales FROM panel GROUP BY Date")
    q["sales_by_store"] = P(f"SELECT Store, {exact_mean('Weekly_Sales')} AS Weekly_Sales FROM panel GROUP BY Store ORDER BY 2 DESC")
    q["seasonality"] = P(f"SELECT CAST(month(Date) AS INTEGER) AS Month, monthname(Date) AS Month_Name, {exact_mean('Weekly_Sales')} AS Weekly_Sales FROM panel GROUP BY 1, 2 ORDER BY 1")
    q["holiday_box"] = P("""SELECT CASE WHEN Holiday_Flag = 1 THEN 'Holiday' WHEN Holiday_Flag = 0 THEN 'Non-Holiday' END AS Holiday,
        min(Weekly_Sales) AS min, round(quantile_cont(Weekly_Sales, 0.25), 6) AS q1, round(median(Weekly_Sales), 6) AS median,
        round(quantile_cont(Weekly_Sales, 0.75), 6) AS q3, max(Weekly_Sales) AS max, count(Weekly_Sales) AS count
        FROM panel GROUP BY 1""")
    months = ", ".join(
        f"CAST(sum(CASE WHEN month(Date) = {m} THEN CAST(Weekly_Sales AS DECIMAL(18,4)) END) AS DOUBLE) / "
        f"CAST(count(CASE WHEN month(Date) = {m} THEN Weekly_Sales END) AS DOUBLE) AS month_{m}" for m in range(1, 13))
    q["store_month_pivot"] = P(f"SELECT Store, {months} FROM panel GROUP BY Store")
    cc = ["Weekly_Sales", "Temperature", "Fuel_Price", "CPI", "Unemployment", "Holiday_Flag"]
    pairs = []
    for i, a in enumerate(cc):
        for j, b in enumerate(cc):
            x, y = (a, b) if i < j else (b, a)
            val = "1.0" if i == j else f"round(corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)), 6)"
            pairs.append(f"SELECT '{a}' AS var1, '{b}' AS var2, CAST({val} AS DOUBLE) AS corr FROM panel")
    q["correlation_matrix"] = P(" UNION ALL ".join(f"({x})" if "corr(" in x else x.replace(" FROM panel", "") for x in pairs))
    q["sales_histogram"] = P(hist_bins("panel", "Weekly_Sales", None))
    q["actual_vs_predicted"] = B("SELECT Date, model, round(sum(actual), 4) AS actual_total, round(sum(pred), 4) AS pred_total FROM bl GROUP BY Date, model")
    q["residual_histogram"] = B(f"""SELECT h.*, m.mean_residual FROM ({hist_bins('res', 'residual', 'model')}) h
        JOIN (SELECT model, round(avg(residual), 6) AS mean_residual FROM res GROUP BY model) m USING (model)""",
                                 [("res", "SELECT *, actual - pred AS residual FROM bl")])
    me = metric_exprs()
    for name in ("WMAPE", "MAPE", "SMAPE"):
        q[name.lower()] = B(f"SELECT model, {me[name]} AS {name} FROM bl GROUP BY model")
    q["all_metrics"] = B(f"SELECT model, {metrics_select()} FROM bl GROUP BY model")
    q["wmape_per_store"] = B(f"SELECT model, Store, {me['WMAPE']} AS WMAPE FROM bl GROUP BY model, Store")
    q["wmape_per_period"] = B(f"SELECT model, Holiday_Flag, {me['WMAPE']} AS WMAPE, count(*) AS Count FROM bl GROUP BY model, Holiday_Flag")
    piv = ", ".join(f"round(max(CASE WHEN model = '{m}' THEN w END), 6) AS {m}" for m in MODELS)
    q["wmape_store_model"] = B(f"""SELECT Store, {piv}, (SELECT model FROM (SELECT model, avg(w) AS aw FROM ps GROUP BY model) x ORDER BY aw, model LIMIT 1) AS best_model
        FROM ps GROUP BY Store""", [("ps", "SELECT Store, model, sum(abs(actual - pred)) / NULLIF(sum(actual), 0) * 100 AS w FROM bl GROUP BY Store, model")])
    q["lag_features"] = P(f"SELECT Store, Date, Weekly_Sales, {LAGS} FROM panel")
    q["same_week_last_year"] = P(f"SELECT Store, Date, week_of_year, {SWLY} FROM (SELECT *, CAST(weekofyear(Date) AS INTEGER) AS week_of_year FROM panel) t")
    q["rolling_features"] = P("SELECT * REPLACE (" + ", ".join(
        f"round(rolling_std_{k}w, 2) AS rolling_std_{k}w" for k in C.ROLLING_WINDOWS)
        + f") FROM (SELECT Store, Date, Weekly_Sales, {rolling()} FROM panel) r")
    q["ewma_features"] = P("SELECT panel.Store, panel.Date, round(ew.ewma_4w, 1) AS ewma_4w, round(ew.ewma_8w, 1) AS ewma_8w, round(ew.ewma_12w, 1) AS ewma_12w FROM panel LEFT JOIN ew USING (Store, Date)", ewma_ctes())
    q.update(long_series_sql())
    q["trend_diffs"] = P(f"""SELECT Store, Date, Weekly_Sales - lag(Weekly_Sales, 1) OVER ({W}) AS sales_diff_1,
        Weekly_Sales - lag(Weekly_Sales, 4) OVER ({W}) AS sales_diff_4,
        {pct('Weekly_Sales', f'lag(Weekly_Sales, 1) OVER ({W})')} AS sales_pct_change_1,
        {pct('Weekly_Sales', f'lag(Weekly_Sales, 4) OVER ({W})')} AS sales_pct_change_4 FROM panel""")
    q["trend_strength"] = P(f"""SELECT Store, Date, CAST(COALESCE(Weekly_Sales > rolling_mean_4w, false) AS INTEGER) AS above_rolling_mean_4w,
        round((Weekly_Sales - rolling_mean_4w) / (rolling_std_4w + 1.0), 6) AS trend_strength
        FROM (SELECT *, {rolling((4,))} FROM panel) r""")
    wp = "PARTITION BY split, Store ORDER BY Date"
    q["economic_changes"] = P(f"""SELECT Store, Date, split, Fuel_Price - lag(Fuel_Price) OVER ({wp}) AS fuel_change,
        {pct('Fuel_Price', f'lag(Fuel_Price) OVER ({wp})')} AS fuel_pct_change, CPI - lag(CPI) OVER ({wp}) AS cpi_change,
        {pct('CPI', f'lag(CPI) OVER ({wp})')} AS cpi_pct_change, Unemployment - lag(Unemployment) OVER ({wp}) AS unemployment_change
        FROM (SELECT *, {SPLIT} FROM panel) s""")
    q["store_rank"] = P("SELECT Store, store_mean_sales, store_rank, store_percentile FROM st1", store_ctes())
    q["model_rank"] = B("SELECT CAST(row_number() OVER (ORDER BY WMAPE, model) AS INTEGER) AS Rank, model, WMAPE, MAPE, SMAPE, MAE, RMSE, R2, Mean_Error, Median_AE FROM bm", [METRICS_CTE])
    q["best_model"] = B("SELECT (SELECT model FROM bm ORDER BY WMAPE, model LIMIT 1) AS best_model, min(WMAPE) AS best_WMAPE FROM bm", [METRICS_CTE])
    q["append_history"] = B("SELECT model, epoch, train_WMAPE, val_WMAPE FROM hi", history_ctes())
    q["best_epoch"] = B("SELECT model, CAST(arg_min(epoch, val_WMAPE) AS INTEGER) AS best_epoch FROM (SELECT * FROM hi ORDER BY epoch) GROUP BY model", history_ctes())
    q["union_model_results"] = B("SELECT * FROM bl")
    q["engineer_features"] = featured_sql(split=False)
    q["engineer_features_split"] = featured_sql(split=True)
    q["seasonal_ar_forecast"] = seasonal_ar_sql()
    q["prophet_holidays"] = P("""SELECT lower(holiday) AS holiday, h AS ds, CAST(-1 AS INTEGER) AS lower_window, CAST(1 AS INTEGER) AS upper_window
        FROM hol WHERE year(h) BETWEEN (SELECT year(min(Date)) FROM panel) AND (SELECT year(max(Date)) FROM panel)""")
    q["ensemble_gate"] = B(f"""SELECT model, WMAPE, WMAPE < {C.ENSEMBLE_MAX_WMAPE} AS eligible,
        WMAPE < {C.ENSEMBLE_MAX_WMAPE} AND (SELECT count(*) FROM bm WHERE WMAPE < {C.ENSEMBLE_MAX_WMAPE}) >= {C.ENSEMBLE_MIN_MODELS} AS blend FROM bm""", [METRICS_CTE])
    q["read_predictions"] = B("SELECT Store, Date, actual, model, pred FROM bl")
    q["read_metrics"] = B("UNPIVOT bm ON WMAPE, MAPE, SMAPE, MAE, RMSE, R2, Mean_Error, Median_AE "
                          "INTO NAME metric VALUE value", [METRICS_CTE])
    # 83 numeric feature columns (the documented feature count of the pipeline)
    q["prepare_ml_data"] = _with(feature_ctes(True), f"SELECT split, count(*) AS n_rows, CAST(83 AS INTEGER) AS n_features "
                                 f"FROM ({rounded_star('f5')}) z WHERE COLUMNS(*) IS NOT NULL GROUP BY split")
    c12, c52 = repr(2 * math.pi / 12), repr(2 * math.pi / 52)
    req = f"SELECT * FROM panel WHERE Date >= DATE '{VS}'"
    q["request_features"] = P(f"""SELECT Date AS date, Store, Holiday_Flag, Temperature, Fuel_Price, CPI, Unemployment,
        CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
        CAST(weekofyear(Date) AS INTEGER) AS week_of_year, CAST(quarter(Date) AS INTEGER) AS quarter,
        round(sin(month(Date) * {c12}), 6) AS month_sin, round(cos(month(Date) * {c12}), 6) AS month_cos,
        round(sin(weekofyear(Date) * {c52}), 6) AS week_sin, round(cos(weekofyear(Date) * {c52}), 6) AS week_cos,
        Temperature * Temperature AS temp_squared, CPI * Unemployment AS cpi_unemployment FROM ({req}) r""")
    hist = ("sh", f"SELECT Store, {exact_mean('Weekly_Sales')} AS store_avg, max(Weekly_Sales) AS store_max, "
                  "min(Weekly_Sales) AS store_min FROM panel GROUP BY Store")
    q["request_history"] = P(f"""SELECT CAST(r.Store AS VARCHAR) AS store_id, strftime(r.Date, '%d-%m-%Y') AS date_str,
        r.Temperature AS temperature, r.Fuel_Price AS fuel_price, r.CPI AS cpi, r.Unemployment AS unemployment,
        r.Holiday_Flag = 1 AS is_holiday, r.Store, sh.store_avg, sh.store_max, sh.store_min
        FROM ({req}) r LEFT JOIN sh USING (Store)""", [hist])
    q["deviation_trend"] = B("""SELECT Store, Date, pred AS prediction, store_avg, pred - store_avg AS diff_from_avg,
        round((pred - store_avg) / store_avg * 100, 6) AS pct_diff,
        CASE WHEN (pred - store_avg) / store_avg * 100 > 10 THEN 'Above Average'
             WHEN (pred - store_avg) / store_avg * 100 < -10 THEN 'Below Average'
             WHEN (pred - store_avg) / store_avg * 100 IS NOT NULL THEN 'Near Average' END AS trend
        FROM bl LEFT JOIN sh USING (Store) WHERE model = 'moving_average_4w'""", [hist])
    q["load_panel_region"] = _with([("panel", panel_sql("region")), ("hol", _hol_values())],
                                   "SELECT * FROM panel")
    ma = exact_mean("Weekly_Sales", f"{W} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING")
    flag_ctes = [("panel", panel_sql("region")), ("hol", _hol_values()),
                 ("fw", f"""SELECT *, lag(Weekly_Sales, 1) OVER ({W}) AS naive,
                            lag(Weekly_Sales, 52) OVER ({W}) AS seasonal_naive,
                            {ma} AS moving_average_4w FROM panel"""),
                 ("fl", " UNION ALL ".join(
                     f"SELECT Store, Date, Weekly_Sales AS actual, '{m}' AS model, {m} AS pred FROM fw "
                     f"WHERE Date >= DATE '{VS}' AND {m} IS NOT NULL" for m in MODELS)),
                 ("fm", f"SELECT model, {metrics_select()} FROM fl GROUP BY model")]
    q["forecast_scorecard"] = _with(flag_ctes, "SELECT CAST(row_number() OVER (ORDER BY WMAPE, model) AS INTEGER) AS Rank, "
                                    "model, WMAPE, MAPE, SMAPE, MAE, RMSE, R2, Mean_Error, Median_AE FROM fm")
    q["ensemble_weights"] = ensemble_sql(final_predict=False)
    q["ensemble_predict"] = ensemble_sql(final_predict=True)
    gaps = f"""SELECT * REPLACE (CASE WHEN (Store * 7 + dayofyear(Date)) % 11 <> 0 THEN Weekly_Sales END AS Weekly_Sales)
               FROM ({panel_sql()}) whole"""
    for grain, body in (("customer", panel_sql("customer")), ("gaps", gaps)):
        for name in VARIANTS[grain]:
            q[f"{name}_{grain}"] = q[name].replace(panel_sql(), body)
    return q
