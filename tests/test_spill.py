"""JB12 spill scenario: the x20 local sort completes with a small heap (fresh process)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, {repo!r})
from flightlake.session import local_session
from flightlake.plans import views
from flightlake.operators import filters, sampling
from flightlake.sources.files import run_noop
spark = local_session(2, shuffle_partitions=4, driver_memory="512m",
                      extra={{"spark.memory.fraction": "0.1"}})
up = sampling.upscale(views.states(spark, "/root/testdata/sf0.01"), 20)
run_noop(sampling.sort_local(filters.typed(up, ["velocity"]), ["velocity"]))
print("ROWS", up.count())
spark.stop()
"""


def test_sort_spill_low_memory(tmp_path):
    script = tmp_path / "spill.py"
    script.write_text(SCRIPT.format(repo=REPO))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600, cwd=str(tmp_path))
    assert out.returncode == 0, out.stderr[-2000:]
    assert "ROWS 200000" in out.stdout


def test_copies_are_sorted_as_one_row(spark, tmp_path):
    """upscaled_local_sort: each partition is in order, and no sort holds the 20 copies."""
    from flightlake.plans import catalog

    spark.range(2000).selectExpr("id AS event_id", "id % 150 AS user_id", "cast(id * 7919 % 1009 AS double) AS value",
                                 "'view' AS event_type").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    out = catalog.QUERIES["upscaled_local_sort"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Sort [")
    order = out.selectExpr("spark_partition_id() p", "coalesce(velocity, -1) v").collect()
    assert len(order) == 20 * 2000
    for p in {r.p for r in order}:
        part = [r.v for r in order if r.p == p]
        assert part == sorted(part)
    copies = out.groupBy("icao24", "time", "velocity").count()
    assert {r["count"] % 20 for r in copies.collect()} == {0}
