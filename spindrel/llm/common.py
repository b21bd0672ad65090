"""Shared plumbing: work tables in the cluster's shared folder, and small helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import shared_folder

#: Bits of a membership bitmap: BITS_PER_KEY for each key, between these two (64 MB).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 29


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches: rows carry whole texts, and a batch of 10,000 could be gigabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


#: Paths of the tables that stage() wrote in this process.
_written: list[str] = []


def stage(df: DataFrame) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back: cuts the
    lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Deletes the table of a stage() that no later plan reads."""
    _delete(df.sparkSession, df.work_path)


def finished(make, *args) -> DataFrame:
    """stage(make(*args)); the work tables that were written on the way are deleted."""
    before = len(_written)
    out = stage(make(*args))
    for path in _written[before:]:
        if path != out.work_path:
            _delete(out.sparkSession, path)
    _written[before:] = [out.work_path]
    return out


def fresh(columns: list[str], name: str) -> str:
    """`name`, or with as many underscores before it as it takes not to be one of `columns`."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bitmap(keys: DataFrame, column: str) -> bytes:
    """A bitmap of 64-bit keys (bit = key mod size), built by native aggregation, that may be
    sent everywhere: its size follows the number of rows up to 64 MB. A clear bit proves
    absence, a set bit proves nothing: an exact join must follow. Beyond some hundred
    million keys it clears ever less, and that join moves ever more; results are the same."""
    size = LEAST_BITS
    wanted = min(MOST_BITS, BITS_PER_KEY * keys.count())
    while size < wanted:
        size *= 2
    pos = F.pmod(F.col(column), F.lit(size)) + 1  # bucket and bit counts start at 1
    rows = (
        keys.select(F.bitmap_bucket_number(pos).alias("b"), F.bitmap_bit_position(pos).alias("p"))
        .groupBy("b")
        .agg(F.bitmap_construct_agg("p").alias("bits"))
    )
    out = bytearray(size // 8)
    for r in rows.toLocalIterator():
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = bytes(r["bits"])
    return bytes(out)


def in_bitmap(bits, keys):
    """Boolean array: which of the int64/uint64 numpy `keys` have their bit set."""
    import numpy as np

    table = np.frombuffer(bits, dtype=np.uint8)
    pos = keys.astype(np.int64, copy=False) & np.int64(8 * len(table) - 1)
    return (table[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1


def _column_bytes(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c.to_numpy(zero_copy_only=False)).tobytes()], pa.binary()) for c in batch.columns], batch.schema.names)


def to_driver(df: DataFrame) -> list:
    """The bigint columns of a table of proven size as numpy arrays, sent in packed form."""
    import numpy as np

    packed = df.mapInArrow(_column_bytes, ", ".join(f"{c} binary" for c in df.columns))
    parts = [[np.frombuffer(bytes(x), dtype=np.int64) for x in r] for r in packed.toLocalIterator()]
    return [np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in range(len(df.columns))]


def complete_groups(batches, key: str):
    """From batches whose rows are sorted by `key`, Arrow tables of whole groups only."""
    import pyarrow as pa

    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cut = int((keys == keys[-1]).argmax())  # the last group may go on in the next batch
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def bounds(keys):
    """Starts and ends of runs of equal values in a sorted numpy array."""
    import numpy as np

    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
    return at, np.concatenate([at[1:], [len(keys)]])
