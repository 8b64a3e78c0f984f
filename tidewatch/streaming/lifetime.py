"""Counters for the lifetime of a device or vendor, as keyed state (STR-05, STR-09, AGG-03/05/11).

``transformWithStateInPandas`` keeps for each (family, device) one value: first and last report, and the
numbers of messages, of black-listed and of accepted ones.  A map of the topic's partitions holds the highest offset that
was counted, so a message that is delivered again changes nothing.  There is no watermark: a row may come
any time late and still counts, since the state is one row a device however long it lives.  The initial
state comes from a batch result, so a stream can take over where the archive ends.  A timer reports a
device that has been silent.

Needs the RocksDB state store (``STATE_CONF``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
KEYS = ("family", "device")
COUNTS = "first_seen TIMESTAMP, last_seen TIMESTAMP, origin_count BIGINT, black_count BIGINT, accepted_count BIGINT"
OUTPUT = f"family STRING, device STRING, {COUNTS}, online BOOLEAN"
#: What ``lifetime_counters`` reads; initial state has the keys and COUNTS.
INPUT = "family STRING, device STRING, ts TIMESTAMP, black BOOLEAN, accepted BOOLEAN, topic STRING, partition INT, offset BIGINT"


class Lifetime(StatefulProcessor):
    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", COUNTS)
        self.offsets = handle.getMapState("offsets", "place STRING", "offset BIGINT")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            self._add(row.first_seen, row.last_seen, int(row.origin_count), int(row.black_count), int(row.accepted_count))

    def _add(self, first, last, n: int, black: int, accepted: int) -> tuple:
        if self.counts.exists():
            a, b, total, bad, good = self.counts.get()
            first, last, n, black, accepted = min(a, first), max(b, last), n + total, black + bad, accepted + good
        new = (pd.Timestamp(first).to_pydatetime(), pd.Timestamp(last).to_pydatetime(), n, black, accepted)
        self.counts.update(new)
        return new

    def _fresh(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Rows beyond the highest offset counted of their partition, each once; the map moves on."""
        rows = rows.drop_duplicates(["topic", "partition", "offset"])
        place = rows["topic"] + "/" + rows["partition"].astype(str)
        keep = pd.Series(True, index=rows.index)
        for name, own in rows.groupby(place):
            key = (str(name),)
            seen = self.offsets.getValue(key)[0] if self.offsets.containsKey(key) else -1
            keep[own.index] = own["offset"] > seen
            self.offsets.updateValue(key, (max(seen, int(own["offset"].max())),))
        return rows[keep]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # offsets of one partition can come in any order within a batch, so they are looked at together
        fresh = self._fresh(pd.concat(rows, ignore_index=True)[["ts", "black", "accepted", "topic", "partition", "offset"]])
        if len(fresh):
            self._add(fresh["ts"].min(), fresh["ts"].max(), len(fresh), int(fresh["black"].fillna(False).sum()), int(fresh["accepted"].fillna(False).sum()))
        if self.silence_ms:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence_ms)
        if self.counts.exists():
            yield self._row(key, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.counts.exists():
            yield self._row(key, False)

    def _row(self, key, online: bool) -> pd.DataFrame:
        first, last, n, black, accepted = self.counts.get()
        return pd.DataFrame({"family": [key[0]], "device": [key[1]], "first_seen": [first], "last_seen": [last], "origin_count": [n], "black_count": [black],
                             "accepted_count": [accepted], "online": [online]})

    def close(self) -> None:
        pass


def lifetime_counters(rows: DataFrame, initial: DataFrame | None = None, silence_minutes: int = 0) -> DataFrame:
    """The state of every (family, device) that a micro-batch changed.  ``rows`` as INPUT; ``initial``: (family,
    device, COUNTS) of the archive; with ``silence_minutes`` a device without a message for so long gets a row with
    ``online = false``; such a query runs batches for its timers without end, so it is not for ``availableNow``."""
    start = initial.groupBy(*KEYS) if initial is not None else None
    return rows.groupBy(*KEYS).transformWithStateInPandas(
        statefulProcessor=Lifetime(silence_minutes * 60_000), outputStructType=OUTPUT, outputMode="Update",
        timeMode="ProcessingTime" if silence_minutes else "None", initialState=start)
