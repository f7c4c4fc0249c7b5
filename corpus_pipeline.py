"""A corpus from raw documents: language ID, line dedup, near-dedup, mixing of sources, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, in the columns of the
table; the last one returns the pieces of the packed sequences. ``run`` writes each result to the
shared folder and gives the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm import language_id, line_dedup, mixing, near_dedup, packing
from tapewatch.llm.common import Scratch, delete, table


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a text that a stage has cut."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(n))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text or without a letter have no language and go."""
    return language_id.drop_unidentified(docs, Scratch(spark, "pipeline-language"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines stay in the first document that has them; no document goes."""
    return _recount(line_dedup.drop_repeated_lines(docs, Scratch(spark, "pipeline-lines"), counts=False))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, on shingles of five words."""
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's budget is cut there."""
    return _recount(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    pieces = packing.pack(docs, Scratch(spark, "pipeline-pack"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("mix_sources", mix), ("pack_along_curve", pack)]

#: The learned classifier, the sketches and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        scratch = Scratch(spark, "pipeline-out")
        out = scratch.put(stage(spark, docs, sf_dir))
        if written is not None:
            delete(spark, written.root)
        docs, written = out, scratch
    return docs
