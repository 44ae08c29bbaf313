"""The bounded dedup of a stream: what the 100,001st hash does, restarts, groups, rows without a hash."""

import pytest

from civiclake.streaming import recent, stream


@pytest.fixture(autouse=True)
def rocksdb(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    recent.with_rocksdb(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def plain(batches, most):
    """First in, first out for each source."""
    held, out = {}, []
    for n, s, h in (r for b in batches for r in b):
        q = held.setdefault(s, [])
        if not h or h not in q:
            out.append(n)
            if h:
                q.append(h)
                del q[:-most]
    return sorted(out)


def run(spark, tmp_path, batches, **options):
    """Each batch as a run of its own from the checkpoint, so each is a restart."""
    path, like = str(tmp_path / "in"), None
    for b in batches:
        df = spark.createDataFrame(b, "n long, s string, h string").coalesce(1).sortWithinPartitions("n")
        df.write.mode("append").parquet(path)
        like = like or df
        rows = recent.dedup_recent(stream.stream_of(spark, path, like, 1), "s", "h", **options)
        stream.run_available(rows, str(tmp_path / "out"), str(tmp_path / "cp"))
    return sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect())


def test_first_in_first_out_over_restarts(spark, tmp_path):
    batches = [
        [(0, "a", "x"), (1, "a", "y"), (2, "a", "x"), (3, "b", "x"), (4, "a", None), (5, "a", ""), (6, "a", None)],
        [(10, "a", "z"), (11, "a", "w"), (12, "a", "x"), (13, "a", "w"), (14, "b", "x")],
        [(20, "a", "y"), (21, "a", "z"), (22, "a", "x"), (23, None, "x"), (24, None, "x")],
    ]
    got = run(spark, tmp_path, batches, most=3)
    assert got == plain(batches, 3)
    assert {2, 13, 14, 24}.isdisjoint(got) and 12 in got


def test_one_more_than_the_bound_evicts_the_first(spark, tmp_path):
    most = 500
    batches = [[(k, "a", f"h{k}") for k in range(most)], [(1000, "a", "h0"), (1001, "a", "new"), (1002, "a", "h0"), (1003, "a", "h2")]]
    got = run(spark, tmp_path, batches, most=most)
    assert got == plain(batches, most) and 1000 not in got and 1001 in got and 1002 in got and 1003 not in got


def test_slots_keep_every_duplicate_together(spark, tmp_path):
    batches = [[(k, "a", f"h{k % 40}") for k in range(200)]]
    assert len(run(spark, tmp_path, batches, most=400, slots=4)) == 40


def test_repeats_ask_no_store():
    """The ring over a plain store that counts what it is asked: rows that repeat a hash cost nothing, evictions hold."""
    import random

    import pandas as pd

    asked = []

    class Store(dict):
        def getValue(self, k):
            asked.append(k)
            return self.get(k)

        def containsKey(self, k):
            asked.append(k)
            return k in self

        updateValue, removeKey = dict.__setitem__, dict.pop

    class One:
        def exists(self):
            return False

        def update(self, v):
            self.v = v

    for hashes, most in ((3, 10), (40, 7), (9, 8)):
        made = recent.RecentHashes(most, None, "h", ["n"])
        made.place, made.ring, made.next = Store(), Store(), One()
        rows = [(k, "a", f"h{random.Random(k).randrange(hashes)}") for k in range(1000)]
        asked.clear()
        parts = [pd.DataFrame(rows[k : k + 90], columns=["n", "s", "h"]) for k in range(0, 1000, 90)]
        got = sorted(n for out in made.handleInputRows(("a",), iter(parts), None) for n in out["n"])
        assert got == plain([rows], most)
        assert hashes > most or len(asked) == hashes
