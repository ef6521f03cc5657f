"""Shuffled, re-split input gives the same results (SURVEY §5 (4))."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF01 = "/root/testdata/sf0.01"
NAMES = ["airport_candidates", "airport_hubs", "one_vote_ground", "extreme_per_aircraft", "top_risks",
         "metadata_coverage", "counter_delta", "stage_intervals", "bench_summary", "aircraft_deduped",
         "hash_sample", "exact_sample", "anomalies", "risk_report"]


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    out = [tuple(None if (isinstance(v, float) and math.isnan(v)) else v for v in r)
           for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple(str(x) for x in r))


@pytest.fixture(scope="module")
def shuffled_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("shuffled")
    for t in ["events", "part", "orders"]:
        (spark.read.parquet(f"{SF01}/{t}.parquet").orderBy(F.rand(11)).repartition(7)
         .write.parquet(str(d / f"{t}.parquet")))
    return str(d)


@pytest.mark.parametrize("name", NAMES)
def test_same_result_on_shuffled_input(spark, shuffled_dir, name):
    q = entry.queries()[name]
    a = _rows(q(spark, SF01).toPandas())
    b = _rows(q(spark, shuffled_dir).toPandas())
    assert a == b
