"""Link verdicts as a stream: a key's state lives in Spark's state store, one step a key.

Every micro-batch is one job: verdicts are shuffled by key, a key's new ones are merged with the
state it has, and what changed leaves as a row. The store commits with the batch, so a batch
that is replayed starts from the state before it and ends with the same one. The state is
read back as a table from the checkpoint.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: Settings that a query takes with it: keyed state needs this store, and timers of processing
#: time would ask for one empty batch after the other.
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_VARIABLE = "link"
#: The status that a change has when a settled verdict is too old.
STALE = "stale"


def _order(row: tuple) -> tuple:
    """Settled verdicts first, then by time and the other columns; nulls are least."""
    return (row[0] in ("yes", "no"), *((False, 0) if v is None else (True, v) for v in row[1:]))


def _plain(v, kind: T.DataType):
    if v is None or v is pd.NaT or v != v:
        return None
    if isinstance(kind, T.IntegralType):
        return int(v)
    return v.to_pydatetime() if isinstance(v, pd.Timestamp) else v


def _milliseconds(at) -> int:
    return int(pd.Timestamp(at).timestamp() * 1000)


class _Links(StatefulProcessor):
    """State of a key: (status, at, extra …), as operators.linkstate.merge has it."""

    def __init__(self, key: str, schema: T.StructType, stale: int | None):
        self.key, self.schema, self.stale = key, schema, stale

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState(_VARIABLE, self.schema)

    def _change(self, key: tuple, row: tuple) -> pd.DataFrame:
        return pd.DataFrame([(*key, *row)], columns=[self.key, *self.schema.names])

    def _rows(self, frame: pd.DataFrame) -> Iterator[tuple]:
        kinds = [f.dataType for f in self.schema.fields]
        for row in frame[self.schema.names].itertuples(index=False, name=None):
            yield tuple(_plain(v, k) for v, k in zip(row, kinds, strict=True))

    def _kept(self, row: tuple) -> None:
        self.state.update(row)
        if self.stale is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if row[0] in ("yes", "no") and row[1] is not None:
                self.handle.registerTimer(_milliseconds(row[1]) + self.stale)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for row in self._rows(initialState):
            self._kept(row)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        have = tuple(self.state.get()) if self.state.exists() else None
        best = have
        for frame in rows:
            for row in self._rows(frame):
                if best is None or _order(row) > _order(best):
                    best = row
        if best is not None and best != have:
            self._kept(best)
            yield self._change(key, best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self._change(key, (STALE, *tuple(self.state.get())[1:]))

    def close(self) -> None:
        pass


def changes(verdicts: DataFrame, key: str, at: str, extra: list[str], *, stale: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """(key, status, at, extra …) of every key whose state a micro-batch changes. Settled verdicts
    (yes, no) give way to later settled ones only, as in operators.linkstate.merge. With `stale`
    (milliseconds; `at` must be a timestamp) a settled one of that age leaves a row with the
    status `stale` in the first batch after; its state stays. `initial` is a state to go on from."""
    columns = [key, "status", at, *extra]
    schema = T.StructType([T.StructField(c, verdicts.schema[c].dataType) for c in columns])
    own = T.StructType(schema.fields[1:])
    before = None if initial is None else initial.select(*columns).groupBy(key)
    return verdicts.select(*columns).groupBy(key).transformWithStateInPandas(_Links(key, own, stale), schema, "Update", "None" if stale is None else "ProcessingTime", before)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _checkpoints(spark: SparkSession, path: str) -> list[str]:
    """The checkpoints that have kept the state of `path`, the last one first."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    numbers = sorted((int(n[3:]) for n in names if n.startswith("at-") and _exists(spark, f"{path}/{n}/_SUCCESS")), reverse=True)
    return [spark.read.text(f"{path}/at-{n}").first()[0] for n in numbers]


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state kept under `path`, or None before the first verdict."""
    for checkpoint in _checkpoints(spark, path):
        if _exists(spark, f"{checkpoint}/commits/0"):
            return spark.read.format("statestore").option("stateVarName", _VARIABLE).load(checkpoint).select("key.*", "value.*")
    return None


def keep_state(verdicts: DataFrame, key: str, at: str, extra: list[str], path: str, checkpoint: str, *, stale: int | None = None, sink=None) -> StreamingQuery:
    """Starts a query that keeps the state of `verdicts` in its checkpoint, and notes under
    `path` that it is there. A query with a new checkpoint goes on from the state so far; one
    whose checkpoint another has taken over from is an error. `sink` takes the writer of the
    changes and returns it with a format; without one they are dropped."""
    spark = verdicts.sparkSession
    known = _checkpoints(spark, path)
    if checkpoint in known[1:]:
        raise ValueError(f"the state of {path} has moved on from {checkpoint}")
    snapshot = f"{path}/before-{zlib.crc32(checkpoint.encode()):08x}"
    if checkpoint not in known:
        state = read_state(spark, path)
        if state is not None:
            state.write.mode("overwrite").parquet(snapshot)
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(f"{path}/at-{len(known)}")
    initial = spark.read.parquet(snapshot) if _exists(spark, f"{snapshot}/_SUCCESS") else None
    out = changes(verdicts, key, at, extra, stale=stale, initial=initial).writeStream.outputMode("update")
    out = (sink(out) if sink else out.format("noop")).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    for k, v in _SETTINGS.items():
        spark.conf.set(k, v)
    try:
        return out.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
