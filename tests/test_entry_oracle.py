"""The correctness gate: every query with an oracle equals DuckDB at sf0.01."""

import math

import pandas as pd
import pytest

import __spark_entry__ as entry
from flightlake.plans import catalog

SF01 = "/root/testdata/sf0.01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _rows(df):
    cols = sorted(df.columns)
    out = []
    for r in df[cols].itertuples(index=False, name=None):
        t = []
        for v in r:
            if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
                v = None
            elif isinstance(v, pd.Timestamp):
                v = v.to_pydatetime()
            elif hasattr(v, "item"):
                v = v.item()
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)), cols


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["lat_cluster", "lon_cluster", "flight_count"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, duck, name):
    s = entry.queries()[name](spark, SF01).toPandas()
    o = duck.execute(entry.oracle_sql()[name]).fetchdf()
    rs, cs = _rows(s)
    ro, co = _rows(o)
    assert cs == co
    assert len(rs) == len(ro)
    assert rs == ro
