"""The pipeline against brute force, stage by stage."""

from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
from pyspark.sql import types as T
from test_operators import brute_components, brute_lines, encoded, words

from tapewatch.llm.common import Scratch


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, None
    for name, stage in pipeline.STAGES:
        out = Scratch(spark, "test-pipeline").put(stage(spark, docs, sf))
        old, new = docs.collect(), out.collect()
        if name != "pack_along_curve":
            assert out.columns == columns
        if name == "language_id":
            assert Counter(r["doc_id"] for r in new) == Counter(
                r["doc_id"] for r in old if r["text"] is not None and any(c.isalpha() for c in r["text"]))
        elif name == "line_dedup":
            want = brute_lines([(r["doc_id"], r["text"]) for r in old])
            assert Counter((r["doc_id"], r["text"]) for r in new) == Counter((k[0], k[3]) for k in want.elements())
            assert all(r["n_chars"] == len(r["text"]) for r in new)
        elif name == "near_dedup":
            components = brute_components([(r["doc_id"], r["text"]) for r in old], 5)
            assert sorted(r["doc_id"] for r in new) == sorted(d for d, _, c in components if d == c)
        elif name == "mix_sources":
            sizes = Counter()
            for r in old:
                sizes[r["source"]] += len(words(r["text"]))
            taken = Counter()
            for r in new:
                taken[r["source"]] += len(words(r["text"]))
            assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
            assert all(taken[s] <= 2 * sizes[s] for s in sizes)
        else:
            want = sum(len(encoded(r["text"])) for r in old)
            assert sum(r["length"] for r in new) == want
            ids = {bytes(encoded(r["text"])) for r in old}
            pieces = {}
            for r in new:
                if r["length"] == r["doc_tokens"]:
                    assert bytes(np.frombuffer(r["ids"], "<u4")) in ids
                pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            assert all(sum(n for _, n in p) <= 4096 for p in pieces.values())
        docs = out


def test_run_gives_the_last_stage(spark, sf):
    rows = pipeline.run(spark, sf)
    assert {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0


CLASHING = ["_id", "_key", "_text_key", "_letter", "_chunks", "_row", "_words", "score", "lang_pred", "lines", "lines_removed", "size", "taken",
            "target", "source_size", "comp", "first", "key", "text_key", "column_0", "column_7", "spans", "c.d"]


def test_stages_keep_columns_of_any_name(spark):
    rows = [(i, f"the cat number {i} sat on a mat\nand the dog {i} stood by it\nas they do on day {i % 3}" if i % 5 else None,
             "en" if i % 2 else "fr", "ab"[i % 2], i, *[f"{c} {i}" for c in CLASHING]) for i in range(40)]
    plain = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    more = T.StructType([T.StructField(c, T.StringType()) for c in CLASHING])
    docs = spark.createDataFrame(rows, T.StructType([*plain.schema.fields, *more.fields]))
    for name, stage in pipeline.STAGES[:-1]:
        want = Counter((r["doc_id"], r["text"]) for r in stage(spark, plain, None).collect())
        out = stage(spark, docs, None)
        assert out.columns == docs.columns, name
        found = out.collect()
        assert Counter((r["doc_id"], r["text"]) for r in found) == want, name
        assert all(r[c] == f"{c} {r['doc_id']}" for r in found for c in CLASHING), name
    assert {r["doc_id"] for r in pipeline.STAGES[-1][1](spark, docs, None).collect()} == set(range(40))
