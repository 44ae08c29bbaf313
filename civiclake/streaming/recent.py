"""Dedup against the most recent hashes: state of a bounded number, first in, first out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Hashes that are remembered for each source.
MOST = 100_000


class RecentHashes(StatefulProcessor):
    """Lets a row through whose hash is not among the last ``most`` that were let through; the oldest is forgotten first.

    State is a ring: the place of a remembered hash, the hash at each place, and the next place. A batch costs a look-up
    for each of its distinct hashes and two writes for each new one, however many are remembered: places that it has met
    are held in the task, twice ``most`` at the most, so a row that repeats one asks no store. With ``idle_ms`` a
    group that has seen nothing for so long forgets all, by a timer.
    """

    def __init__(self, most: int, idle_ms: int | None, digest: str, columns: list[str]):
        self.most, self.idle_ms, self.digest, self.columns = most, idle_ms, digest, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getMapState("place", "hash string", "place long")
        self.ring = handle.getMapState("ring", "place long", "hash string")
        self.next = handle.getValueState("next", "place long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        at = self.next.get()[0] if self.next.exists() else 0
        # Places of hashes met in this call; the last ``most`` places are remembered, older ones are forgotten.
        met: dict[str, int] = {}
        for part in rows:
            fresh = []
            for h in part[self.digest]:
                # Rows without a hash can't be told apart and all stay.
                if h is None or h != h or h == "":
                    fresh.append(True)
                    continue
                known = met.get(h)
                if known is None:
                    known = self.place.getValue((h,))
                    known = met[h] = known[0] if known else -1
                new = known < 0 or known < at - self.most
                fresh.append(new)
                if new:
                    if at >= self.most:
                        self.place.removeKey(self.ring.getValue((at % self.most,)))
                    self.ring.updateValue((at % self.most,), (h,))
                    self.place.updateValue((h,), (at,))
                    met[h] = at
                    at += 1
                if len(met) > 2 * self.most:
                    met = {k: p for k, p in met.items() if p >= at - self.most}
            yield part.loc[fresh, self.columns]
        self.next.update((at,))
        if self.idle_ms:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.place, self.ring, self.next):
            state.clear()
        yield pd.DataFrame({c: [] for c in self.columns})

    def close(self) -> None:
        pass


def dedup_recent(df: DataFrame, source: str, digest: str, most: int = MOST, slots: int = 1, idle_ms: int | None = None) -> DataFrame:
    """The rows of a stream whose hash is not among the last ``most`` of their source; rows without a hash all stay.

    A source is one group of state. A busy one is spread with ``slots``: a hash always goes to the same slot, each holds
    its share of ``most``, and first in, first out holds in each slot. Needs the RocksDB state store; a restart goes on
    from the checkpoint.
    """
    slot = F.coalesce(F.pmod(F.xxhash64(digest), F.lit(slots)).cast("int"), F.lit(0))
    made = RecentHashes(max(1, most // slots), idle_ms, digest, df.columns)
    groups = df.withColumns({"_group": F.col(source), "_slot": slot}).groupBy("_group", "_slot")
    return groups.transformWithStateInPandas(made, outputStructType=df.schema, outputMode="append", timeMode="ProcessingTime" if idle_ms else "None")


def with_rocksdb(spark) -> None:
    """The state store that ``dedup_recent`` needs, for queries started from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
