import datetime as dt

from crashlens.operators.clean import clean_pings
from crashlens.operators.daily import profile_day
from crashlens.params import APP_NAME as APP
from crashlens.params import fixture_params

RAW = ("cid bigint, sid string, channel string, sd string, appname string, ssl bigint, cssm bigint, cdc bigint, "
       "sk bigint, cdgmp bigint, cdp bigint, pcd int, e10s boolean")


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_filters_and_fill(spark):
    p = fixture_params()
    ok = (1, "42", "release", "20240105", APP, 600, None, None, None, None, None, 19700, True)
    rows = [
        ok,
        (2, "7", "release", "20240105", APP, 600, 1, 0, 0, 0, 0, 19700, True),          # off sample
        (3, "42", "beta", "20240105", APP, 600, 1, 0, 0, 0, 0, 19700, True),           # off channel
        (4, "42", "release", "20240105", "other-app", 600, 1, 0, 0, 0, 0, 19700, True),         # off app
        (5, "42", "release", "20160630", APP, 600, 1, 0, 0, 0, 0, 19700, True),        # before sd floor
        (6, "42", "release", "20240105", APP, None, 1, 0, 0, 0, 0, 19700, True),       # NULL session (D1)
        (7, "42", "release", "20240105", APP, -1, 1, 0, 0, 0, 0, 19700, True),         # negative session
        (8, "42", "release", "20240105", APP, 86401, 1, 0, 0, 0, 0, 19700, True),      # over-long session
        (9, "42", "release", "20240105", APP, 600, 1, 0, 0, 0, 0, 14000, True),        # created too early
        (10, "42", "release", "20240105", APP, 600, 1, 0, 0, 0, 0, 20000, True),       # created after today
        (11, "42", "release", "20240105", APP, 600, 1, 0, 0, 0, 0, 19700, None),       # NULL e10s
        (12, "42", "release", "20240105", APP, 86400, 1, 0, 0, 0, 0, 14610, False),    # both bounds inclusive
        (13, "42", "release", "20240105", APP, 0, 1, 0, 0, 0, 0, 19753, False),
    ]
    out = clean_pings(_raw(spark, rows), p).orderBy("cid").collect()
    assert [r.cid for r in out] == [1, 12, 13]
    assert (out[0].cssm, out[0].cdc, out[0].sk, out[0].cdgmp, out[0].cdp) == (0, 0, 0, 0, 0)


def test_profile_day_rollup(spark):
    rows = [
        (1, "42", "release", "20240105", APP, 600, 1, 2, 3, 1, 2, 19700, True),
        (1, "42", "release", "20240105", APP, 300, 0, 1, 0, 0, 0, 19690, True),
        (1, "42", "release", "20240105", APP, 100, 1, 0, 0, 0, 0, 19700, False),
    ]
    pd = profile_day(_raw(spark, rows)).orderBy("e10s").collect()
    off, on = pd
    assert (on.ssl, on.cssm, on.cdc, on.cdpgmp, on.pcd) == (900, 1, 0, 3, 19690)  # cdc - sk; min(pcd)
    assert (off.ssl, off.cssm) == (100, 1)
    assert on.day == dt.date(2024, 1, 5)


def test_fixture_counts_sf001(spark):
    """FIXTURES.md sanity numbers at sf0.01."""
    from pyspark.sql import functions as F

    from crashlens.sources.fixtures import fixture_pings
    from tests.conftest import SF01

    raw = fixture_pings(spark, SF01)
    assert raw.count() == 10000
    pd = profile_day(clean_pings(raw, fixture_params()))
    r = pd.agg(F.count("*").alias("n"), F.countDistinct("cid").alias("p"), F.sum("cssm").alias("m"),
               F.sum("cdc").alias("c"), F.sum("cdpgmp").alias("g"), F.min("cdc").alias("mc")).first()
    assert (r.n, r.p, r.m, r.c, r.g, r.mc) == (4760, 129, 147, 21, 790, -2)
    assert pd.filter("ssl = 0").count() == 219
