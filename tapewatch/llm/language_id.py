"""Language identification in two levels: family first, then one-versus-one linear SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapewatch.llm.common import Scratch, anonymous, as_binary, bytes_and_offsets, lean, table
from tapewatch.llm.tokens import split_batch

FEATURES = 4096
ORDERS = (1, 2, 3)
UNKNOWN = "und"


def _grams(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per order, the hashed byte n-grams of the lower-cased texts in turn, and n + 1 offsets."""
    raw, at = bytes_and_offsets(pc.utf8_lower(texts.fill_null("")))
    codes, offsets, wide = [], [], raw.astype(np.uint32)
    for n in ORDERS:
        if len(raw) >= n:
            code = wide[:len(raw) - n + 1].copy()
            for i in range(1, n):
                code = code * np.uint32(257) + wide[i:len(raw) - n + 1 + i]
            code = ((code + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20)
        else:
            code = np.zeros(0, np.uint32)
        # a gram must begin and end in its text
        doc_end = np.repeat(at[1:], np.diff(at))[:len(code)]
        inside = np.arange(len(code)) + n <= doc_end
        counts = np.maximum(np.diff(at) - n + 1, 0)
        codes.append(code[inside])
        offsets.append(np.concatenate(([0], np.cumsum(counts))))
    return codes, offsets


def features(texts: pa.Array) -> np.ndarray:
    """Shares of the hashed byte n-grams, each order summing to one."""
    out = np.zeros((len(texts), FEATURES), np.float64)
    for code, at in zip(*_grams(texts)):
        for i in range(len(texts)):
            if at[i + 1] > at[i]:
                out[i] += np.bincount(code[at[i]:at[i + 1]], minlength=FEATURES) / (at[i + 1] - at[i])
    return out


def margins(texts: pa.Array, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Decision values of several linear models at once, without building the features."""
    out = np.tile(bias, (len(texts), 1))
    for code, at in zip(*_grams(texts)):
        filled = np.flatnonzero(np.diff(at))
        if len(filled):
            for m in range(weights.shape[0]):
                out[filled, m] += np.add.reduceat(weights[m][code], at[filled]) / np.diff(at)[filled]
    return out


@dataclass(frozen=True)
class LanguageModel:
    """``families`` of languages; ``pairs`` of families, then of languages, with one linear model each."""
    families: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[str, int, int], ...]
    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Index in ``languages`` and a score from 0 to 1: the least certainty of the decisions taken."""
        n = len(texts)
        if not self.languages:
            return np.full(n, -1), np.zeros(n)
        values = margins(texts, self.weights, self.bias)
        family, sure = self._vote(values, "family", range(len(self.families)), n)
        chosen, score = np.zeros(n, np.int64), np.zeros(n)
        for f, members in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            inside = [self.languages.index(m) for m in members]
            found, certain = self._vote(values[rows], "language", inside, len(rows))
            chosen[rows], score[rows] = found, np.minimum(sure[rows], certain)
        return chosen, score

    def _vote(self, values: np.ndarray, kind: str, among, n: int) -> tuple[np.ndarray, np.ndarray]:
        among = list(among)
        votes, least = np.zeros((n, len(among))), np.ones((n, len(among)))
        for m, (what, a, b) in enumerate(self.pairs):
            if what == kind and a in among and b in among:
                i, j = among.index(a), among.index(b)
                p = 1 / (1 + np.exp(-2 * np.clip(values[:, m], -30, 30)))
                votes[:, i] += (p > 0.5) + p / (1 + len(among))  # equal votes: the larger sum of margins
                votes[:, j] += (p <= 0.5) + (1 - p) / (1 + len(among))
                least[:, i], least[:, j] = np.minimum(least[:, i], p), np.minimum(least[:, j], 1 - p)
        best = votes.argmax(axis=1)
        return np.array(among)[best] if n else np.zeros(0, np.int64), least[np.arange(n), best]


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _families(centroids: np.ndarray) -> list[list[int]]:
    """Average-link grouping of languages by the likeness of their mean features, to about the root of their number."""
    norm = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    alike, groups = norm @ norm.T, [[i] for i in range(len(centroids))]
    while len(groups) > max(1, int(np.ceil(np.sqrt(len(centroids))))):
        a, b = max(combinations(range(len(groups)), 2),
                   key=lambda p: np.mean([alike[i, j] for i in groups[p[0]] for j in groups[p[1]]]))
        groups[a] = sorted(groups[a] + groups[b])
        del groups[b]
    return groups


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 20, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with hinge loss, by coordinate descent on its dual.

    ``y`` is 1 or -1. Features are scaled by their deviation for the fit; the weights are for unscaled ones.
    """
    scale = x.std(axis=0)
    scale = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)
    z = np.column_stack((x * scale, np.ones(len(x)))).astype(np.float32)
    norm, alpha, w = (z * z).sum(axis=1), np.zeros(len(z)), np.zeros(z.shape[1])
    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in draw.permutation(len(z)):
            step = float(np.clip(alpha[i] + (1 - y[i] * (z[i] @ w)) / norm[i], 0, c)) - alpha[i]
            if step:
                w += step * y[i] * z[i]
                alpha[i] += step
                moved = max(moved, abs(step) * norm[i])
        if moved < 1e-3:
            break
    return w[:-1] * scale, float(w[-1])


def fit(docs: DataFrame, scratch: Scratch, per_language: int = 1000) -> LanguageModel:
    """Learn from text and language of the rows that are not held out.

    At most ``per_language`` rows of each language are used, those with the least hash of their id (null
    ids are not learned from), so the sample does not depend on how the rows are stored. Every pair of
    families and every pair of languages of one family is a group of its own with at most 2 * ``per_language``
    rows, fitted side by side; the driver gets a weight vector per pair.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & has_letter())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    labelled = usable.select("lang", "doc_id", "text")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    # a share that keeps somewhat more than wanted, then the exact bound on the few that are left
    some = labelled.join(F.broadcast(scratch.put(sizes)), "lang").filter(draw * F.col("_n") <= per_language * 1.2 + 50)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    some = some.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("lang", "_rank", "text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                x = features(part.column(2)).astype("<f4")
                yield pa.record_batch([part.column(0), part.column(1), as_binary([v.tobytes() for v in x])], ["lang", "rank", "x"])

    rows = scratch.put(some.mapInArrow(run, "lang string, rank int, x binary"))

    def mean(key, frame):
        import pandas as pd
        total = sum(np.frombuffer(x, "<f4").astype(np.float64) for x in frame["x"])
        return pd.DataFrame({"lang": [key[0]], "x": [(total / len(frame)).astype("<f8").tobytes()]})

    means = rows.groupBy("lang").applyInPandas(mean, "lang string, x binary").orderBy("lang").collect()  # a row per language
    languages = [r["lang"] for r in means]
    groups = _families(np.array([np.frombuffer(r["x"], "<f8") for r in means])) if languages else []
    pairs = [("family", a, b) for a, b in combinations(range(len(groups)), 2)]
    pairs += [("language", a, b) for g in groups for a, b in combinations(g, 2)]
    weights, bias = np.zeros((len(pairs), FEATURES)), np.zeros(len(pairs))
    if pairs:
        # (language, pair, side, rows of the language that take part)
        roles = [(languages[i], m, side, per_language // len(groups[member]) if kind == "family" else per_language)
                 for m, (kind, a, b) in enumerate(pairs) for side, member in ((1, a), (-1, b))
                 for i in (groups[member] if kind == "family" else [member])]
        spark = docs.sparkSession
        named = F.broadcast(spark.createDataFrame(roles, "lang string, pair int, side int, most int"))  # a few rows per pair
        dealt = rows.join(named, "lang").filter(F.col("rank") <= F.greatest("most", F.lit(1))).select("pair", "side", "rank", "lang", "x")

        def train(key, frame):
            import pandas as pd
            frame = frame.sort_values(["lang", "rank"])
            x = np.frombuffer(b"".join(frame["x"]), "<f4").reshape(-1, FEATURES)
            w, b = linear_svm(x, frame["side"].to_numpy())
            return pd.DataFrame({"pair": [key[0]], "w": [w.astype("<f8").tobytes()], "b": [b]})

        for r in dealt.groupBy("pair").applyInPandas(train, "pair int, w binary, b double").collect():
            weights[r["pair"]], bias[r["pair"]] = np.frombuffer(r["w"], "<f8"), r["b"]
    scratch.keep_only()
    return LanguageModel(tuple(tuple(languages[i] for i in g) for g in groups), tuple(pairs), tuple(languages), weights, bias)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    Only the text is looked at. Null text and text without a letter is ``und`` with score 0, as is
    everything when nothing could be learned. Rows are kept as they are, repeated ones too.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a few vectors per pair of languages
    inner, back = anonymous(docs, "text")
    kept = inner.columns
    rows = inner.withColumn("_letter", has_letter())
    schema = T.StructType([*inner.schema.fields] + [T.StructField("lang_pred", T.StringType()),
                                                            T.StructField("score", T.DoubleType())])
    at = kept.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for batch in batches:
            for lo, hi in split_batch(batch.column(at), 2 << 20):
                part = batch.slice(lo, hi - lo)
                chosen, score = shared.value.predict(part.column(at))
                known = part.column(len(kept)).to_numpy(zero_copy_only=False) & (chosen >= 0)
                yield pa.record_batch([*[part.column(i) for i in range(len(kept))],
                                       pa.array(names[np.where(known, chosen, -1)], pa.string()),
                                       pa.array(np.where(known, score, 0.0))], [*kept, "lang_pred", "score"])
    added = ["lang_pred", "score"]
    return back(rows.mapInArrow(run, schema), added, added)


def drop_unidentified(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` without the rows whose language is ``und``; fitted on the labelled ones among them. All columns stay.

    When nothing can be learned, only rows whose text is null or has no letter go.
    """
    (inner, back), model = anonymous(docs, "text"), fit(docs, scratch)
    if not model.languages:
        return docs.filter(has_letter())
    return back(identify(inner, model).filter(F.col("lang_pred") != UNKNOWN))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "op10")
    found = identify(docs.select("doc_id", "text"), fit(docs, scratch))
    return scratch.finish(found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))
