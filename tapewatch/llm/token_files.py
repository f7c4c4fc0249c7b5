"""Token ids in files of length-limited canonical Huffman codes, decoded by table in independent blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import Scratch, lean, table
from tapewatch.llm.files import Reader, create
from tapewatch.llm.tokens import default_tokenizer, id_bytes, split_batch, vocabulary, word_encoder
from tapewatch.session import parallelism

MAX_BITS = 18
BLOCK_IDS = 1 << 18
#: ids between two bit-offset checkpoints of a block
STRIDE = 128


# ---- codes ----------------------------------------------------------------------------------

def limited_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Code lengths of an optimal prefix code with no code over ``limit`` bits (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    n, packages, levels = len(leaves), np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate((leaves, packages))
        at = np.argsort(merged, kind="stable")
        levels.append(at < n)
        merged = merged[at]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    need, sorted_lengths = 2 * n - 2, np.zeros(n, np.uint8)
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:need].sum())
        sorted_lengths[:taken] += 1
        need = 2 * (need - taken)
    lengths[order] = sorted_lengths
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id), so that the lengths alone describe the code."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        code <<= bits - before
        before = bits
        ids = np.flatnonzero(lengths == bits)
        codes[ids] = np.arange(code, code + len(ids), dtype=np.uint64)
        code += len(ids)
    return codes


class Code:
    """Encoder and table-driven decoder of one canonical code."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.codes = canonical_codes(lengths)
        self.bits = int(lengths.max(initial=1))
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.length = np.ones(1 << self.bits, np.int64)
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        spans = np.int64(1) << (self.bits - lengths[order].astype(np.int64))
        self.symbol[:int(spans.sum())] = np.repeat(order, spans)
        self.length[:int(spans.sum())] = np.repeat(lengths[order], spans)

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """The bits of ``ids`` and the bit offset of every ``stride``-th id."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        size = self.lengths[ids].astype(np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        start, total = at[:-1], int(at[-1])
        word, code = start >> 6, self.codes[ids]
        shift = 64 - (start & 63) - size
        whole = shift >= 0
        head = np.where(whole, code << np.where(whole, shift, 0).astype(np.uint64),
                        code >> np.where(whole, 0, -shift).astype(np.uint64))
        words = np.zeros((total + 63) // 64 + 1, np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.bitwise_or.reduceat(head, first)
        over = np.flatnonzero(~whole)
        words[word[over] + 1] |= code[over] << (64 + shift[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[:(total + 7) // 8], start[::stride].copy()

    def decode(self, payload: bytes, count: int, checkpoints: np.ndarray, stride: int = STRIDE) -> np.ndarray:
        """All stretches between checkpoints are decoded side by side, one id of each per step."""
        if not count:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint64)
        window = (raw[:-4] << np.uint64(32)) | (raw[1:-3] << np.uint64(24)) | (raw[2:-2] << np.uint64(16)) \
            | (raw[3:-1] << np.uint64(8)) | raw[4:]
        window = window.astype(np.int64)
        at, lanes = checkpoints.astype(np.int64), len(checkpoints)
        out = np.zeros((min(stride, count), lanes), np.uint32)
        mask, last = (1 << self.bits) - 1, len(window) - 1
        for step in range(len(out)):
            seen = (window[np.minimum(at >> 3, last)] >> (40 - self.bits - (at & 7))) & mask
            out[step] = self.symbol[seen]
            at = at + self.length[seen]
        return out.T.ravel()[:count] if len(out) == stride else out.T.ravel()


# ---- blocks ---------------------------------------------------------------------------------

_HEAD = np.dtype([("docs", "<i8"), ("ids", "<i8"), ("marks", "<i8"), ("payload", "<i8")])


def pack_block(code: Code, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """Header, document ids with a null flag, ids per document, checkpoints, payload."""
    payload, marks = code.encode(ids)
    head = np.array([(len(doc_ids), len(ids), len(marks), len(payload))], _HEAD)
    return b"".join([
        head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), lengths.astype("<i8").tobytes(),
        marks.astype("<i8").tobytes(), payload])


def unpack_block(code: Code, block: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    head = np.frombuffer(block, _HEAD, 1)[0]
    n, at = int(head["docs"]), _HEAD.itemsize
    doc_ids = np.frombuffer(block, "<i8", n, at).tolist()
    nulls = np.frombuffer(block, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(block, "<i8", n, at + 9 * n)
    marks = np.frombuffer(block, "<i8", int(head["marks"]), at + 17 * n)
    start = at + 17 * n + 8 * len(marks)
    ids = code.decode(block[start:start + int(head["payload"])], int(head["ids"]), marks)
    return [None if z else d for d, z in zip(doc_ids, nulls)], lengths, ids


# ---- jobs -----------------------------------------------------------------------------------

def tokenize(docs: DataFrame, tokenizer: str, end_id: int, width: str) -> DataFrame:
    """``doc_id, n_tokens, ids``: every whole text's ids and the end id, as little-endian numbers of ``width``."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, end_id)
        for batch in batches:
            for lo, hi in split_batch(batch.column(1)):
                ids, at = encoder.encode(batch.column(1).slice(lo, hi - lo))
                yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)),
                                       id_bytes(ids, at, width).cast(pa.binary())], ["doc_id", "n_tokens", "ids"])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, ids binary"))


def id_counts(tokens: DataFrame, width: str) -> np.ndarray:
    """Global counts per id; the driver gets one row per id of the vocabulary at most."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0):
                found = np.bincount(np.frombuffer(value.as_buffer(), width))
                if len(found) > len(total):
                    found[:len(total)] += total
                    total = found
                else:
                    total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["id", "n"])
    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_files(tokens: DataFrame, width: str, lengths: np.ndarray, root: str, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Files in ascending order of ``doc_id`` (null first); one manifest row per block."""
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)  # a byte per id of the vocabulary

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, stream, path, offset, number, start = Code(shared.value), None, None, 0, 0, 0
        doc_ids, parts, held = [], [], 0

        def flush():
            nonlocal stream, path, offset, number, start, doc_ids, parts, held
            if stream is None:
                path, stream = create(root, ".huf")
            block = pack_block(code, doc_ids, np.array([len(p) for p in parts]), np.concatenate(parts))
            stream.write(block)
            row = pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([path]),
                                   *[pa.array([v], pa.int64()) for v in (number, offset, len(block), start, held, len(doc_ids))]],
                                  ["part", "file", "block", "offset", "bytes", "before", "ids", "docs"])
            offset, number, start = offset + len(block), number + 1, start + held
            doc_ids, parts, held = [], [], 0
            return row

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                parts.append(np.frombuffer(value.as_buffer(), width))
                held += len(parts[-1])
                if held >= block_ids:
                    yield flush()
        if doc_ids:
            yield flush()
        if stream is not None:
            stream.close()

    ordered = (tokens.select("doc_id", "ids", F.crc32("ids").alias("_tie"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "ids"))
    return ordered.mapInArrow(run, "part long, file string, block long, offset long, bytes long, "
                                   "before long, ids long, docs long")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``start``, the ids of all blocks before; running sums over one row per file."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (manifest.groupBy("part").agg(F.sum("ids").alias("_ids"))
              .select("part", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base")))
    return manifest.join(totals, "part").withColumn("start", F.col("_base") + F.col("before")).drop("_base")


def read_files(manifest: DataFrame, lengths: np.ndarray) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian unsigned 32 bits) decoded from the files of a manifest."""
    spark = manifest.sparkSession
    shared = spark.sparkContext.broadcast(lengths)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, reader = Code(shared.value), Reader()
        for batch in batches:
            for file, offset, size, start in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                doc_ids, counts, ids = unpack_block(code, reader.read(file, offset, size))
                at = np.concatenate(([0], np.cumsum(counts)))
                yield pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(start + at[:-1]), pa.array(counts),
                                       id_bytes(ids, at, "<u4").cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
        reader.close()

    spread = with_starts(manifest).select("file", "offset", "bytes", "start").repartition(4 * parallelism(spark), "file", "offset")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def huffman_files(docs: DataFrame, scratch: Scratch, tokenizer: str | None = None, end_id: int = 2,
                  block_ids: int = BLOCK_IDS) -> tuple[DataFrame, np.ndarray]:
    """Tokenize, count, write. Returns the manifest of the files and the code lengths that describe the code.

    Null text is empty: only the end id. Null and repeated ids are kept, null first. Columns other
    than ``doc_id`` and ``text`` are ignored. An empty table gives no file.
    """
    tokenizer = tokenizer or default_tokenizer()
    width, _ = vocabulary(docs.sparkSession, tokenizer)
    tokens = scratch.put(tokenize(docs, tokenizer, end_id, width))
    lengths = limited_lengths(id_counts(tokens, width))
    manifest = scratch.put(write_files(tokens, width, lengths, f"{scratch.root}/files", block_ids))
    scratch.drop(tokens)
    return manifest, lengths


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Per document, from the files: its start, its number of ids and their checksum."""
    scratch = Scratch(spark, "op4")
    manifest, lengths = huffman_files(table(spark, sf_dir, "documents"), scratch, tokenizer)
    return scratch.finish(read_files(manifest, lengths).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))
