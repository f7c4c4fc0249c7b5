"""Token ids of whole texts, encoded once per distinct word of a worker's share."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from tapewatch.llm.common import lean

#: word pieces a worker remembers, over tasks; what has not been met for long is learned anew, which changes nothing
CACHE_PIECES = 300_000

# Words of these characters stay as they are under NFC and lower-case one character at a time.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
# How the vocabulary's own file splits a lower-cased text; the line end stands between words here.
_PIECES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+")


def _spelling(tokenizer) -> dict[int, str] | None:
    """How the model of the file spells the letters over ASCII of a plain word; none if it is not a BPE model whose
    words are only cut and then spelt by bytes. What is visible in ASCII stays as it is."""
    from tokenizers import models, pre_tokenizers
    steps = tokenizer.pre_tokenizer
    found = json.loads(steps.__getstate__()) if steps else {}
    kinds = [(s["type"], s.get("use_regex"), s.get("add_prefix_space")) for s in found.get("pretokenizers", [])]
    if not isinstance(tokenizer.model, models.BPE) or kinds != [("Split", None, None), ("ByteLevel", False, False)]:
        return None
    step = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: step.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}


class WordEncoder:
    """``encode_batch`` for a BPE vocabulary whose pieces never span white space.

    Such a vocabulary gives a text the ids of its white-space separated words, one after the other, so
    each distinct word of a batch is looked at once. Plain words are cut to the pieces that the
    vocabulary's own file names, and each distinct piece is encoded once per worker. Any other word
    (other scripts, combining marks, special tokens) goes to the tokenizer as it is.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.ends_word = np.zeros(self.size, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.spelling = _spelling(self.tokenizer)
        self._fresh()
        self.older = self.known, self.ids[0], self.lengths[0]

    def _fresh(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, np.uint32)]
        self.lengths = [np.zeros(0, np.int64)]

    def _age(self) -> None:
        """Two generations: a full one becomes the older, and pieces met again move to the new one."""
        if len(self.known) >= CACHE_PIECES // 2:
            self.older = self.known, self.ids[0], self.lengths[0]
            self._fresh()

    def _recall(self, pieces: list[str]) -> list[str]:
        """Take what the older generation knows; the rest is returned."""
        known, ids, lengths = self.older
        found = [p for p in pieces if p in known]
        if found:
            at = pa.array([known[p] for p in found], pa.int64())
            taken = _ragged(ids, lengths).take(at)
            self._remember(found, taken.flatten().to_numpy(), np.diff(taken.offsets.to_numpy()))
        return [p for p in pieces if p not in known]

    def _remember(self, keys: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.known)
        self.known.update(zip(keys, range(first, first + len(keys))))
        self.ids.append(ids.astype(np.uint32))
        self.lengths.append(lengths.astype(np.int64))

    def _encode_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for i in range(0, len(words), 1000)
                 for e in self.tokenizer.encode_batch(words[i:i + 1000], add_special_tokens=False)]
        lengths = np.array([len(c) for c in coded], np.int64)
        return np.array([i for c in coded for i in c], np.uint32), lengths

    def _learn(self, pieces: list[str]) -> None:
        """A lower-cased piece is already cut out as the vocabulary's file says, so the model alone encodes it."""
        for i in range(0, len(pieces), 2000):
            part = pieces[i:i + 2000]
            if self.spelling:
                tokenize = self.tokenizer.model.tokenize
                coded = [[t.id for t in tokenize(p)] for p in " ".join(part).translate(self.spelling).split(" ")]
                self._remember(part, np.array([i for c in coded for i in c], np.uint32), np.array([len(c) for c in coded]))
                continue
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                self._remember(part, ids, np.diff(ends, prepend=0))
            else:
                self._remember(part, *self._encode_each(part))

    def _distinct_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct words, one word after the other, and the number of ids of each."""
        plain = pc.match_substring_regex(words, _PLAIN)
        plain = pc.and_(plain, pc.invert(pc.match_substring(words, "<|"))).to_numpy(zero_copy_only=False)
        found = _PIECES.findall("\n".join(_strings(pc.utf8_lower(words.filter(pa.array(plain))))))
        pieces = pa.array(found, pa.string()).dictionary_encode()
        distinct = _strings(pieces.dictionary)
        self._age()
        known = self.known
        self._learn(self._recall([p for p in distinct if p not in known and p != "\n"]))
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        breaks = [i for i, p in enumerate(distinct) if p == "\n"]
        at = np.array([known.get(p, 0) for p in distinct], np.int64)
        which = pieces.indices.to_numpy()
        is_break = which == breaks[0] if breaks else np.zeros(len(which), bool)
        store = _ragged(self.ids[0], self.lengths[0])
        of_piece = store.take(pa.array(at[which[~is_break]]))
        word_of = np.cumsum(is_break)[~is_break]
        piece_lengths = np.diff(of_piece.offsets.to_numpy())
        n_plain = int(plain.sum())
        plain_lengths = np.bincount(word_of, weights=piece_lengths, minlength=n_plain).astype(np.int64)[:n_plain]
        lengths = np.zeros(len(words), np.int64)
        lengths[plain] = plain_lengths
        flat_plain = of_piece.flatten().to_numpy()
        if plain.all():
            return flat_plain, lengths
        flat_other, lengths[~plain] = self._encode_each(words.filter(pa.array(~plain)).to_pylist())
        out = np.empty(int(lengths.sum()), np.uint32)
        of_plain = np.repeat(plain, lengths)
        out[of_plain], out[~of_plain] = flat_plain, flat_other
        return out, lengths

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end id, and n + 1 offsets. Null counts as empty."""
        n = len(texts)
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        flat = split.flatten()
        solid = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(solid)))[offsets - offsets[0]]
        words = flat.filter(pa.array(solid)).dictionary_encode()
        ids, lengths = self._distinct_words(words.dictionary)
        end = len(lengths)
        store = _ragged(np.append(ids, np.uint32(self.end_id)), np.append(lengths, 1))
        order = np.insert(words.indices.to_numpy().astype(np.int64), offsets[1:], end)
        coded = store.take(pa.array(order))
        return coded.flatten().to_numpy(), coded.offsets.to_numpy().astype(np.int64)[offsets + np.arange(n + 1)]


def _strings(column: pa.Array) -> list[str]:
    """``to_pylist`` of a column without nulls, without a scalar per value."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _ragged(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


_encoders: dict[tuple[str, int, bool], WordEncoder] = {}


def word_encoder(path: str, end_id: int, ordinary: bool = False) -> WordEncoder:
    """The worker's encoder, which outlives a task with the pieces it remembers. ``ordinary`` takes the strings of
    special tokens as text."""
    key = (path, end_id, ordinary)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, end_id)
        _encoders[key].tokenizer.encode_special_tokens = ordinary
    return _encoders[key]


def split_batch(column: pa.Array, rows_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``rows_bytes`` each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, size in enumerate(sizes):
        total += int(size) + 1
        if total >= rows_bytes:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def id_bytes(ids: np.ndarray, offsets: np.ndarray, dtype: str) -> pa.Array:
    """One binary value per document."""
    data = ids.astype(dtype)
    at = offsets * data.dtype.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])


def unsigned_width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def vocabulary(spark: SparkSession, tokenizer: str, token: str = "") -> tuple[str, int]:
    """Width of the ids and the id of ``token`` (-1 if there is none), found out in a task: the driver loads no tokenizer."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                encoder = word_encoder(tokenizer, 0)
                found = encoder.tokenizer.token_to_id(token)
                yield pa.record_batch([pa.array([encoder.size]), pa.array([-1 if found is None else found], pa.int64())], ["size", "id"])
    row = spark.range(1).repartition(1).mapInArrow(run, "size long, id long").first()
    return unsigned_width(row["size"]), row["id"]
