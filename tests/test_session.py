"""Intermediate tables: written, told apart, removed."""

import os
import threading

from flightlake.session import drop_stored, stored, stored_tables


def _local(path):
    return path.replace("file:", "", 1)


def test_stored_tables_are_dropped(spark):
    before = set(stored_tables())
    a, b = stored(spark.range(3), "a"), stored(spark.range(4), "b")
    new = [t for t in stored_tables() if t not in before]
    assert len(new) == 2 and all(os.path.isdir(_local(t)) for t in new)
    assert a.count() == 3
    drop_stored(spark, new[:1])
    assert not os.path.exists(_local(new[0])) and b.count() == 4
    assert [t for t in stored_tables() if t not in before] == new[1:]


def test_other_threads_keep_theirs(spark):
    seen = []

    def other():
        stored(spark.range(2), "other")
        seen.extend(stored_tables())

    before = set(stored_tables())
    t = threading.Thread(target=other)
    t.start()
    t.join()
    assert len(seen) == 1 and set(stored_tables()) == before
