"""Top types of complete windows, inside the stream.

The serving state of :mod:`pulse.streaming.sinks` merges and ranks changed
windows again on every micro-batch. Here a window is ranked once, when the
watermark has closed it: the windowed count emits its final rows (append mode,
partial counts before the shuffle), and a second stateful operator keeps only
what a window can still show: its ``n`` greatest values (map state) and its
total (value state), until an event-time timer gives the rows out and clears
both. No file is read back; state is a handful of rows for each open window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pulse.config import OTHERS_LABEL, TOP_TYPES, WATERMARK, WINDOW_BY_TYPE

OUTPUT = "window_start timestamp, window_end timestamp, final_type string, cnt long"


class TopProcessor(StatefulProcessor):
    """One window's greatest values; ties by value, nulls first, as the batch ranking has it."""

    def __init__(self, n: int, other: str):
        self.n, self.other = n, other

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a null type is a value of its own, so the key says whether it is there
        self.top = handle.getMapState("top", "known boolean, value string", "cnt long")
        self.sums = handle.getValueState("sums", "total long, kinds long")

    @staticmethod
    def _order(entry):
        (known, value), cnt = entry
        return -cnt, known, value.encode()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, kinds = self.sums.get() if self.sums.exists() else (0, 0)
        held = {(k[0], k[1]): v[0] for k, v in self.top.iterator()}
        before = set(held)
        for part in rows:
            for value, cnt in zip(part["event_type"], part["cnt"]):
                known = value is not None and value == value
                held[(known, value if known else "")] = int(cnt)
                total, kinds = total + int(cnt), kinds + 1
            if len(held) > self.n:
                held = dict(sorted(held.items(), key=self._order)[:self.n])
        for k in before - set(held):
            self.top.removeKey(k)
        for k in set(held) - before:
            self.top.updateValue(k, (held[k],))
        self.sums.update((total, kinds))
        self.handle.registerTimer(int(pd.Timestamp(key[1]).value // 1_000_000) - 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, kinds = self.sums.get()
        labels: dict[str | None, int] = {}
        for k, v in self.top.iterator():
            label = k[1] if k[0] else None
            labels[label] = v[0]
        if kinds > len(labels):             # a real value named like the bucket is one with it
            rest = total - sum(labels.values())
            labels[self.other] = labels.get(self.other, 0) + rest
        self.top.clear()
        self.sums.clear()
        yield pd.DataFrame({"window_start": key[0], "window_end": key[1], "final_type": list(labels), "cnt": list(labels.values())})

    def close(self) -> None:
        pass


def top_types_closed(events: DataFrame, n: int = TOP_TYPES, other: str = OTHERS_LABEL, window: str = WINDOW_BY_TYPE, watermark: str = WATERMARK) -> DataFrame:
    """Streaming ``window_start, window_end, final_type, cnt``: each window's top ``n`` types and ``other``, once it is closed.

    Append mode; the same rows as ``top_n_with_others`` gives for that window.
    Needs the RocksDB state store (:func:`pulse.streaming.jobs.use_rocksdb_state`).
    Late events beyond the watermark don't count; windows open at the end of a
    run come out when a later run's watermark passes them.
    """
    counts = (events.withWatermark("event_time", watermark).groupBy(F.window("event_time", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("cnt"))
              .select("w", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "cnt"))
    return (counts.select("window_start", "window_end", "event_type", "cnt").groupBy("window_start", "window_end")
            .transformWithStateInPandas(TopProcessor(n, other), OUTPUT, "append", "eventTime"))
