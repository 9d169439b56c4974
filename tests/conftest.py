import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crashlens.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

PD_SCHEMA = "cid bigint, sd string, day date, e10s boolean, pcd int, ssl bigint, cssm bigint, cdc bigint, cdpgmp bigint"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4)
    yield s


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def epoch(s: str) -> int:
    return (d(s) - dt.date(1970, 1, 1)).days


def pd_rows(spark, rows):
    """rows: (cid, 'YYYY-MM-DD', e10s, pcd, ssl, cssm, cdc, cdpgmp)"""
    out = []
    for cid, day, e10s, pcd, ssl, cssm, cdc, cdpgmp in rows:
        out.append((cid, day.replace("-", ""), d(day), e10s, pcd, ssl, cssm, cdc, cdpgmp))
    return spark.createDataFrame(out, PD_SCHEMA)
