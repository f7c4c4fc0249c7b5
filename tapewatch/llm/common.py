"""What the operators share: intermediate tables, bounded filters, Arrow batches, words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.session import fresh_path

#: The white space that separates words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[32, 9, 10, 11, 12, 13]] = True

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the bytes of an Arrow batch, so that a run of very long texts cannot exhaust a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def anonymous(docs: DataFrame, *known: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """``docs`` with its columns but the ``known`` ones under names that mean nothing, and a function that gives a table
    its original columns back, in their order, without those named in ``but`` and with those in ``more``."""
    names = {c: c if c in known else f"column_{i}" for i, c in enumerate(docs.columns)}
    of = lambda c: F.col("`" + c.replace("`", "``") + "`")

    def back(df: DataFrame, but: Sequence[str] = (), more: Sequence[str] = ()) -> DataFrame:
        return df.select(*[F.col(names[c]).alias(c) for c in docs.columns if c not in but], *more)

    return docs.select(*[of(c).alias(name) for c, name in names.items()]), back


class Scratch:
    """Tables of one operator run, in the folder that ``spark.checkpoint.dir`` names.

    Each is written once, so it survives lost executors, cuts the lineage and carries its true size.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = bounded_batches(spark)
        self.root = fresh_path(spark, name)
        self.count = 0

    def put(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in tables:
            delete(self.spark, df._scratch_path)

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables but these, which a result still reads."""
        kept = {df._scratch_path for df in tables}
        for i in range(1, self.count + 1):
            if f"{self.root}/{i}" not in kept:
                delete(self.spark, f"{self.root}/{i}")

    def finish(self, df: DataFrame) -> DataFrame:
        """Write the result beside the scratch tables, delete those, and return it."""
        path = f"{self.root}-result"
        df.write.option("compression", "zstd").parquet(path)
        delete(self.spark, self.root)
        return self.spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: called when a task ends, to drop what a module has kept for it
CLEANERS: list = []


def lean(function):
    """For functions of ``mapInArrow``: a worker that has done its task gives freed memory back to the system.

    Workers outlive tasks, and several stand beside each executor's heap.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            for clean in CLEANERS:
                clean()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return run


def bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a string or binary array as one byte array and n + 1 offsets; null counts as empty."""
    column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offsets[0]) if n else 0
    return raw[first:int(offsets[-1])] if n else raw[:0], offsets - first


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


class KeyFilter:
    """A bit map of fixed size over 64-bit keys: tells keys that cannot be in a set from those that may be.

    It only spares a shuffle: whatever passes is decided exactly afterwards, so a full map costs
    time and never a row. The broadcast is ``bits / 8`` bytes at any size of the input.
    """

    def __init__(self, keys: DataFrame, column: str, bits: int = 1 << 26):
        spark = keys.sparkSession
        self.bits = bits
        piece = 1 << 16

        def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(bits, bool)
            for batch in batches:
                column = batch.column(0)
                seen[mix64(column.drop_null().to_numpy().view(np.uint64)) % np.uint64(bits)] = True
            packed = np.packbits(seen).reshape(-1, piece // 8 if bits >= piece else bits // 8)
            used = np.flatnonzero(packed.any(axis=1))
            yield pa.record_batch([pa.array(used.astype(np.int64)), as_binary([packed[i].tobytes() for i in used])],
                                  ["piece", "bytes"])

        def merge(key, frame):
            import pandas as pd
            parts = [np.frombuffer(b, np.uint8) for b in frame["bytes"]]
            return pd.DataFrame({"piece": [key[0]], "bytes": [np.bitwise_or.reduce(parts).tobytes()]})

        schema = "piece long, bytes binary"
        found = (keys.select(column).mapInArrow(pieces, schema)
                 .groupBy("piece").applyInPandas(merge, schema).collect())  # bits / 8 bytes at most
        whole = np.zeros(bits // 8, np.uint8).reshape(-1, min(piece, bits) // 8)
        for row in found:
            whole[row["piece"]] = np.frombuffer(row["bytes"], np.uint8)
        self.map = spark.sparkContext.broadcast(whole.ravel())

    def test(self, keys: np.ndarray) -> np.ndarray:
        """For use inside a task: false where a key is surely not in the set."""
        at = mix64(keys) % np.uint64(self.bits)
        return ((self.map.value[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1).astype(bool)

    def may_hold(self, key: Column) -> Column:
        """False where ``key`` is surely not in the set; null keys count as perhaps in it."""
        held = self

        @F.pandas_udf("boolean")
        def test(keys):
            import pandas as pd
            known = keys.notna().to_numpy()
            return pd.Series(held.test(keys.fillna(0).to_numpy(np.int64).view(np.uint64)) | ~known)

        return test(key)
