"""Blocks that are written once, when they have ended.

A keyed operator with a finaliser: state holds a block's rows as a list, a timer
marks when the block has ended, and the finaliser then sees all its rows at once,
as in batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: The state store that lists and timers need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Blocks(StatefulProcessor):
    def __init__(self, schema: StructType, time: str, order: list[str], gap_ms: int, finish: Callable[[pd.DataFrame], pd.DataFrame]):
        self.schema, self.time, self.order, self.gap_ms, self.finish = schema, time, order, gap_ms, finish

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.ends = handle.getValueState("ends", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for p in rows:
            if len(p):
                self._hold(p)
                t = _ms(p[self.time].min())
                first = t if first is None else min(first, t)
        if first is not None:
            self._wake(first + self.gap_ms)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Blocks that no row can join any more are written; the rest waits."""
        self.ends.clear()
        now = timerValues.getCurrentWatermarkInMs()
        rows = pd.DataFrame(list(self.rows.get()), columns=self.schema.fieldNames())
        self.rows.clear()
        if not len(rows):
            return
        rows = rows.sort_values(self.time, kind="stable")
        at = rows[self.time].map(_ms)
        for _, block in rows.groupby((at.diff() > self.gap_ms).cumsum(), sort=True):
            end = _ms(block[self.time].iloc[-1]) + self.gap_ms
            if end <= now:
                yield self.finish(block.sort_values(self.order, kind="stable").reset_index(drop=True))
            else:
                self._hold(block)
                self._wake(end)

    def _hold(self, rows: pd.DataFrame) -> None:
        self.rows.appendList([tuple(r) for r in rows.astype(object).where(rows.notna(), None).itertuples(index=False)])

    def _wake(self, at: int) -> None:
        """One timer a key: the earliest time at which a block may have ended."""
        old = self.ends.get()
        if old is None or at < old[0]:
            if old is not None:
                self.handle.deleteTimer(old[0])
            self.ends.update((at,))
            self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def _ms(at: pd.Timestamp) -> int:
    return int(pd.Timestamp(at).value // 1_000_000)


def finalised_blocks(rows: DataFrame, key: str, time: str, order: list[str], finish: Callable[[pd.DataFrame], pd.DataFrame], schema: str, gap_seconds: int, late: str) -> DataFrame:
    """finish(block) of each key's rows, sorted by ``order``, once no row has come
    for ``gap_seconds`` of event time; a key that comes again later is a new block.

    ``time`` is the event time; rows later than ``late`` are left out.  State is
    kept in RocksDB lists, so a block's rows are in memory only when it ends; it
    must fit a worker then, as a group does in batch.  How rows fall into
    micro-batches makes no difference: blocks are parted by their times when the
    watermark has passed them.  Rows must have a time;
    write it in append mode.  A restarted query goes on from its checkpoint."""
    marked = rows.withWatermark(time, late)
    processor = _Blocks(rows.schema, time, order, gap_seconds * 1000, finish)
    return marked.groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def in_batch(rows: DataFrame, key: str, time: str, order: list[str], finish: Callable[[pd.DataFrame], pd.DataFrame], schema: str, gap_seconds: int) -> DataFrame:
    """What finalised_blocks gives in the end, from a whole table."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(time)
    apart = F.col(time).cast("double") - F.lag(time).over(w).cast("double") > gap_seconds
    blocks = rows.withColumn("__new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("__block", F.sum("__new").over(w))
    run = lambda p: finish(p.drop(columns=["__new", "__block"]).sort_values(order, kind="stable").reset_index(drop=True))
    return blocks.groupBy(key, "__block").applyInPandas(run, schema)
