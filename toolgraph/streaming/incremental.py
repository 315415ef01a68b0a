"""Incremental evaluation: records are judged as they arrive, what has been judged is kept in the query's checkpoint."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType


def evaluate_new(arriving: DataFrame, key: str, time: str, evaluate: Callable[[DataFrame], DataFrame], late: str = "30 days") -> DataFrame:
    """A streaming table of evaluations, each key once within the watermark: resumable work as a stream."""
    return evaluate(arriving.withWatermark(time, late).dropDuplicatesWithinWatermark([key]))


class Remembered(StatefulProcessor):
    """Keeps of each key what was last judged and the result; judges again only what has changed."""

    def __init__(self, key: str, content: str, judge: Callable[[str], dict], names: list[str]):
        self.key, self.content, self.judge, self.names = key, content, judge, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("judged", "content string, version long")

    def handleInputRows(self, key, rows, timer_values):
        known, version = self.state.get() if self.state.exists() else (None, 0)
        latest = None
        for frame in rows:
            for order, content in zip(frame["order_"], frame[self.content], strict=True):
                if latest is None or (order, content or "") > latest:
                    latest = (order, content or "")
        if latest is None or version and latest[1] == known:
            return
        version += 1
        self.state.update((latest[1], version))
        result = self.judge(latest[1])
        yield pd.DataFrame({self.key: [key[0]], "version": [version]} | {n: [result.get(n)] for n in self.names})

    def close(self) -> None:
        pass


def evaluate_changes(arriving: DataFrame, key: str, content: str, order: str, judge: Callable[[str], dict], schema: str) -> DataFrame:
    """(key, version, *schema): a streaming table with a row whenever a key's content is new or another than the last one judged; a key is never forgotten, so what has come once isn't judged again however late it comes again.

    arriving: a stream of (key, content, order); of a key's rows in one batch the last by ``order`` (of equals the greatest content) counts. judge(content) gives a dictionary of the schema's fields; it runs in tasks, once for each change.
    State holds one content and a number for each key, in the state store (the session has to be set to the RocksDB one), spread over the shuffle partitions by key; many rows of one key are read as a stream of batches. A null content is the empty text.
    """
    fields = StructType.fromDDL(schema)
    kind = arriving.schema[key].dataType.simpleString()
    last = F.col(order).cast("string" if arriving.schema[order].dataType.simpleString() == "string" else "double").alias("order_")
    rows = arriving.where(f"{key} is not null").select(key, content, last)
    spec = f"{key} {kind}, version long, {schema}"
    return rows.groupBy(key).transformWithStateInPandas(Remembered(key, content, judge, fields.names), outputStructType=StructType.fromDDL(spec), outputMode="Append", timeMode="None")


def current(evaluations: DataFrame, key: str) -> DataFrame:
    """The last evaluation of each key, of those that a stream has written so far; rows that were written twice count once."""
    others = [c for c in evaluations.columns if c not in (key, "version")]
    return evaluations.groupBy(key).agg(F.max_by(F.struct("version", *others), "version").alias("e")).select(key, "e.*")


def counts_by_window(events: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))
