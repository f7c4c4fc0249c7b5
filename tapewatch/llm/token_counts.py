"""Token counts of flat token files: blocks are searched for the end id and stitched by a prefix scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, lean, table
from tapewatch.llm.files import Reader, create
from tapewatch.llm.tokens import default_tokenizer, split_batch, vocabulary, word_encoder
from tapewatch.session import parallelism

END = "<|endoftext|>"
BLOCK_BYTES = 4 << 20
#: blocks that one task of the scan over blocks sees at once
SPAN = 4096


def write_flat(docs: DataFrame, root: str, tokenizer: str, end_id: int, width: str) -> DataFrame:
    """One flat file per scan partition: the ids of each document and the end id, nothing else.

    Returns ``file, bytes, first, doc_ids``: which documents went into a file, in order, from ordinal ``first``.
    """
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id, ordinary=True)  # a text cannot hold the end id
        path, stream, first, size = None, None, 0, 0
        for batch in batches:
            for lo, hi in split_batch(batch.column(1)):
                if stream is None:
                    path, stream = create(root, ".ids")
                ids, _ = encoder.encode(batch.column(1).slice(lo, hi - lo))
                data = ids.astype(width).tobytes()
                stream.write(data)
                yield pa.record_batch([pa.array([path]), pa.array([len(data)]), pa.array([first]),
                                       pa.array([batch.column(0).slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64()))],
                                      ["file", "bytes", "first", "doc_ids"])
                first += hi - lo
        if stream is not None:
            stream.close()
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "file string, bytes long, first long, doc_ids array<long>"))


def scan_blocks(files: DataFrame, end_id: int, width: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block of each file (``file, bytes``): ``file, block, tokens, ends`` — the positions of end ids in it."""
    item = np.dtype(width).itemsize
    block_bytes = block_bytes // item * item

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for file, block, size in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                offset = block * block_bytes
                ids = np.frombuffer(reader.read(file, offset, min(block_bytes, size - offset) // item * item), width)
                ends = np.flatnonzero(ids == end_id)
                yield pa.record_batch([pa.array([file]), pa.array([block]), pa.array([len(ids)]),
                                       pa.array([ends + offset // item], pa.list_(pa.int64()))], ["file", "block", "tokens", "ends"])
        reader.close()

    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / F.lit(block_bytes))
                                                       .cast("long"))).alias("block"), "bytes")
    return (blocks.repartition(4 * parallelism(files.sparkSession), "file", "block")
            .mapInArrow(run, "file string, block long, tokens long, ends array<long>"))


def token_counts(files: DataFrame, scratch: Scratch, end_id: int, width: str = "<u2",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of flat token files: ``file, ordinal, start, n_tokens, ended``.

    ``files`` has ``file, bytes``; files have no index, only ids of ``width`` with ``end_id`` behind each
    document. ``n_tokens`` counts the end id; what follows the last one in a file is a document that
    has not ``ended``. Empty files give no rows; bytes beyond the last whole id are not read.

    A block reports where its end ids are. Documents that cross blocks are stitched by a prefix scan: for
    each block the last end id and the number of end ids before it, first within spans of blocks,
    then over the spans, so no task sees all blocks of a long file.
    """
    blocks = scratch.put(scan_blocks(files.filter(F.col("bytes") > 0), end_id, width, block_bytes))
    marks = blocks.select("file", "block", "tokens", F.size("ends").cast("long").alias("n"),
                          F.when(F.size("ends") > 0, F.element_at("ends", -1)).alias("last"),
                          F.floor(F.col("block") / F.lit(SPAN)).alias("span"))
    spans = marks.groupBy("file", "span").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    over_spans = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("file", "span", F.coalesce(F.sum("n").over(over_spans), F.lit(0)).alias("span_n"),
                         F.max("last").over(over_spans).alias("span_last"))
    inside = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select("file", "span", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("in_n"),
                         F.max("last").over(inside).alias("in_last"))
    carried = marks.join(spans, ["file", "span"]).select(
        "file", "block", (F.col("in_n") + F.col("span_n")).alias("before"),
        (F.coalesce("in_last", "span_last", F.lit(-1)) + 1).alias("begin"))
    # sides that grow with the input are never broadcast: in memory they are far larger than their files
    each = (blocks.hint("merge").join(carried, ["file", "block"])
            .withColumn("starts", F.concat(F.array("begin"), F.transform("ends", lambda e: e + 1)))
            .select("file", "before", "starts", F.posexplode("ends").alias("i", "end")))
    ended = each.select("file", (F.col("before") + F.col("i")).alias("ordinal"),
                        F.element_at("starts", F.col("i") + 1).alias("start"), "end")
    ended = ended.select("file", "ordinal", "start", (F.col("end") - F.col("start") + 1).alias("n_tokens"),
                         F.lit(True).alias("ended"))
    whole = blocks.groupBy("file").agg(F.sum("tokens").alias("_tokens"), F.sum(F.size("ends")).alias("ordinal"),
                                       F.max(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).alias("_last"))
    begin = F.coalesce(F.col("_last") + 1, F.lit(0))
    open_end = whole.filter(F.col("_tokens") > begin).select(
        "file", "ordinal", begin.alias("start"), (F.col("_tokens") - begin).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(open_end)


def op6_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Writes all documents to flat token files, then counts each document's tokens from the files alone."""
    scratch = Scratch(spark, "op6")
    tokenizer = tokenizer or default_tokenizer()
    width, end_id = vocabulary(spark, tokenizer, END)
    written = scratch.put(write_flat(table(spark, sf_dir, "documents"), f"{scratch.root}/flat", tokenizer, end_id, width))
    files = written.groupBy("file").agg(F.sum("bytes").alias("bytes"))
    counts = token_counts(files, scratch, end_id, width)
    names = written.select("file", "first", F.posexplode("doc_ids").alias("i", "doc_id")).select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id")
    return scratch.finish(counts.hint("merge").join(names, ["file", "ordinal"]).select("doc_id", "n_tokens", "ended"))
