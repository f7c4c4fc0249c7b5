"""Spark's event logs as it writes them: one file per run, or a folder of numbered parts, plain or compressed.

Since version 4 a run is a folder ``eventlog_v2_<application>`` of parts ``events_<number>_<application>.zstd``
unless settings say otherwise. A compacted part stands for all parts up to its number, which may still be
there. The last part of a run that goes on, or that was killed, may end anywhere.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes that a task decodes at a time
CHUNK = 1 << 20

# Names that Spark gives to the folders, parts and codecs of logs.
_FOLDER = r"/eventlog_v2_([^/]+)/events_(\d+)_[^/]+$"
_STATUS = r"/eventlog_v2_[^/]+/appstatus_[^/]*$"
_SINGLE = r"([^/]+?)(\.(zstd|lz4|snappy|lzf))?(\.inprogress)?$"
_CODEC = r"\.(zstd|lz4|snappy|lzf)(\.compact|\.inprogress)?$"
_LZ4_MAGIC, _SNAPPY_MAGIC = b"LZ4Block", b"\x82SNAPPY\x00"


def _rolled(path: Column) -> Column:
    return path.rlike(_FOLDER)


def run_of(path: Column) -> Column:
    """The application (and attempt) that a log file belongs to."""
    return F.when(_rolled(path), F.regexp_extract(path, _FOLDER, 1)).otherwise(F.regexp_extract(path, _SINGLE, 1))


def part_of(path: Column) -> Column:
    """The number of a part; 0 for a log of one file."""
    return F.when(_rolled(path), F.regexp_extract(path, _FOLDER, 2).cast("int")).otherwise(F.lit(0))


def log_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """The files of ``files`` that make up the runs, with ``run, part, codec`` beside their other columns.

    Marker files go, and so do parts up to the number of their run's last compacted part, but that itself.
    ``codec`` is empty for a plain file. ``files`` is read twice, once for its paths alone: a run's files, which may
    carry their content, stay in the tasks they are in, as a run may have any number of them.
    """
    name = F.col(path)
    named = files.filter(~name.rlike(_STATUS)).withColumns({
        "run": run_of(name), "part": part_of(name), "codec": F.regexp_extract(name, _CODEC, 1)})
    compact = name.endswith(".compact")
    # a narrow row per compacted run, of which there are no more than logs
    last = named.filter(compact).groupBy(F.col("run").alias("_run")).agg(F.max("part").alias("_last"))
    live = F.col("_last").isNull() | (F.col("part") > F.col("_last")) | (compact & (F.col("part") == F.col("_last")))
    return named.join(F.broadcast(last), F.col("run") == F.col("_run"), "left").filter(live).drop("_run", "_last")


def _zstd(data: memoryview) -> Iterator[bytes]:
    import zstandard
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
    while chunk := reader.read(CHUNK):
        yield chunk


def _lz4(data: memoryview) -> Iterator[bytes]:
    """Blocks with a header of magic, method, compressed length, length and checksum."""
    at = 0
    while at + 21 <= len(data):
        if data[at:at + 8] != _LZ4_MAGIC:
            raise ValueError("not a block of an lz4 log")
        method, packed, size = data[at + 8] & 0xF0, *struct.unpack("<ii", data[at + 9:at + 17])
        block = data[at + 21:at + 21 + packed]
        if len(block) < packed:
            return
        if size:
            yield bytes(block) if method == 0x10 else pa.decompress(block, size, "lz4_raw", asbytes=True)
        at += 21 + packed


def _snappy(data: memoryview) -> Iterator[bytes]:
    """A header of 16 bytes at the start of each stream, then blocks with their length."""
    at = 0
    while at + 4 <= len(data):
        if data[at:at + 8] == _SNAPPY_MAGIC:
            at += 16
            continue
        packed, = struct.unpack(">i", data[at:at + 4])
        block = data[at + 4:at + 4 + packed]
        if len(block) < packed:
            return
        size, shift = 0, 0
        for byte in block[:5]:
            size |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
        if size:
            yield pa.decompress(block, size, "snappy", asbytes=True)
        at += 4 + packed


_DECODERS = {"": lambda data: iter([bytes(data)]), "zstd": _zstd, "lz4": _lz4, "snappy": _snappy}


def text_lines(codec: str, data: memoryview) -> Iterator[list[str]]:
    """The lines of a file, some at a time; what is left after the last line end counts as a line."""
    if codec not in _DECODERS:
        raise ValueError(f"event logs compressed by {codec} cannot be read")
    rest = b""
    for chunk in _DECODERS[codec](data):
        *whole, rest = (rest + chunk).split(b"\n")
        if whole:
            yield [line.decode("utf-8", "replace") for line in whole]
    if rest:
        yield [rest.decode("utf-8", "replace")]


def decode_parts(parts: DataFrame) -> DataFrame:
    """``run, part, value``: the lines of files given as ``run, part, codec, content``. A file is one task's work, so
    use it for parts, which Spark starts anew at a bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, part, codec, content in zip(*[batch.column(i) for i in range(4)]):
                for lines in text_lines(codec.as_py(), memoryview(content.as_buffer() if content.is_valid else b"").cast("B")):
                    yield pa.record_batch([pa.array([name.as_py()] * len(lines), pa.string()),
                                           pa.array([part.as_py()] * len(lines), pa.int32()), pa.array(lines, pa.string())],
                                          ["run", "part", "value"])

    return parts.select("run", "part", "codec", "content").mapInArrow(run, "run string, part int, value string")


def event_log_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``run, part, value``: the lines of all runs below ``path``: a log, a folder of a run's parts, or a folder of logs.

    Plain files are read as text, in splits; compressed ones whole, one task each. Nothing to read gives no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    # a row per file, as many as the driver lists to plan the scan
    found = log_parts(files).select("path", "codec").collect()
    plain, packed = [r["path"] for r in found if not r["codec"]], [r["path"] for r in found if r["codec"]]
    name = F.col("_metadata.file_path")
    lines = spark.createDataFrame([], "run string, part int, value string")
    if plain:
        lines = spark.read.text(plain).select(run_of(name).alias("run"), part_of(name).alias("part"), "value")
    if packed:
        content = spark.read.format("binaryFile").load(packed).select("path", "content")
        decoded = decode_parts(content.withColumns({
            "run": run_of(F.col("path")), "part": part_of(F.col("path")), "codec": F.regexp_extract("path", _CODEC, 1)}))
        lines = lines.unionByName(decoded) if plain else decoded
    return lines
