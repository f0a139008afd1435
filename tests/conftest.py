import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import build_session
    s = build_session("local[4]", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelcast-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="panelcast-test-", dir="/tmp")


def make_panel(spark, rows):
    """rows: (Store, 'YYYY-MM-DD', sales[, flag, temp, fuel, cpi, unemp])."""
    import datetime as dt
    full = []
    for r in rows:
        store, d, y = r[0], dt.date.fromisoformat(r[1]), float(r[2])
        rest = list(r[3:]) + [None] * (5 - len(r[3:]))
        flag = int(rest[0]) if rest[0] is not None else 0
        temp = float(rest[1]) if rest[1] is not None else 60.0
        fuel = float(rest[2]) if rest[2] is not None else 3.0
        cpi = float(rest[3]) if rest[3] is not None else 200.0
        un = float(rest[4]) if rest[4] is not None else 8.0
        full.append((store, d, y, flag, temp, fuel, cpi, un))
    return spark.createDataFrame(
        full, "Store int, Date date, Weekly_Sales double, Holiday_Flag int, Temperature double, "
              "Fuel_Price double, CPI double, Unemployment double")


def weekly_panel(spark, stores=2, weeks=60, start="2010-02-05", seed=0):
    import datetime as dt
    import random
    rnd = random.Random(seed)
    d0 = dt.date.fromisoformat(start)
    rows = []
    for s in range(1, stores + 1):
        for w in range(weeks):
            d = d0 + dt.timedelta(days=7 * w)
            rows.append((s, d.isoformat(), round(rnd.uniform(5e5, 2e6), 2), 0,
                         round(rnd.uniform(30, 90), 2), round(rnd.uniform(2.5, 4), 3),
                         round(rnd.uniform(180, 230), 3), round(rnd.uniform(5, 12), 3)))
    return make_panel(spark, rows)
