"""Mixing sources to target weights by hash-random keys, distributed prefix sums and an exact cut."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapewatch.llm.common import SPACE, WORD, Scratch, table

#: rows of one key range of a source; only the range that holds a source's cut is sorted row by row
RANGE_ROWS = 4096


def word_count(text: Column | str) -> Column:
    """Number of words; null counts as none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def random_key(doc_id: str, seed: int) -> Column:
    """A key that looks random but depends on the id and the seed alone, so reruns agree."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))))


def _fraction(key: str) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _before(df: DataFrame, scratch: Scratch, order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Adds, for each named value, its sum over all rows earlier in the order.

    Rows are range-partitioned and sorted; the one-task step adds up a row per partition.
    """
    placed = scratch.put(df.withColumns({f"_v_{k}": v for k, v in values.items()})
                         .repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_slot", F.monotonically_increasing_id())
                         .withColumn("_part", F.shiftright("_slot", 33)))
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(*[F.sum(f"_v_{k}").alias(f"_s_{k}") for k in values])
    sums = sums.select("_part", *[F.coalesce(F.sum(f"_s_{k}").over(parts), F.lit(0)).alias(f"_o_{k}") for k in values])
    out = placed.withColumns({k: F.coalesce(F.sum(f"_v_{k}").over(inside), F.lit(0)) for k in values})
    out = out.join(sums, "_part")
    return (out.withColumns({k: F.col(k) + F.col(f"_o_{k}") for k in values})
            .drop("_part", "_slot", *[f"{p}{k}" for k in values for p in ("_v_", "_o_")]))


def source_targets(sized: DataFrame, scratch: Scratch, weights: Sequence[int] = (3, 1, 2),
                   share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, source_rows, target``.

    Sources in code-point order (null last) take the weights in turn and share ``share`` times all
    words. A target stops at ``most`` times its source; what is over goes to the others by weight
    until none is above. In the order of cap / weight the stopped sources come first, so the level
    of the rest follows from two running sums, without iterating.
    """
    per_source = scratch.put(sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                         F.count(F.lit(1)).alias("source_rows")))
    ranked = _before(per_source.withColumn("_null", F.col("source").isNull()), scratch,
                     ["_null", "source"], {"_rank": F.lit(1)})
    turn = F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")
    capped = ranked.select("source", "source_size", "source_rows",
                           F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn + 1).alias("weight"))
    capped = capped.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    capped = _before(capped.withColumn("_ratio", F.col("cap") / F.col("weight"))
                     .withColumn("_null", F.col("source").isNull()), scratch,
                     ["_ratio", "_null", "source"],
                     {"_caps": F.col("source_size"), "_weights": F.col("weight").cast("long")})
    total = per_source.agg(F.coalesce(F.sum("source_size"), F.lit(0))).scalar()
    weight = capped.agg(F.sum("weight")).scalar()
    level = (total * F.lit(float(share)) - F.col("_caps") * F.lit(float(most))) / (weight - F.col("_weights"))
    capped = scratch.put(capped.withColumn("_level", level)
                         .withColumn("_stops", F.col("_ratio") <= F.col("_level")))
    # levels fall along the sources that are not stopped, also where their ratios tie: the first is the largest
    final = capped.filter(~F.col("_stops")).agg(F.max("_level")).scalar()
    return capped.select("source", "source_size", "source_rows",
                         F.when(F.col("_stops"), F.col("cap")).otherwise(F.col("weight") * final).alias("target"))


def mix_plan(docs: DataFrame, scratch: Scratch, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
             most: float = 2.0, seed: int = 1, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(sized, plan)``: the rows as ``doc_id, source, size, _key`` and, per source, its target and cut.

    Each source's rows are put in the order of a hash-random key, in ranges of about ``range_rows``.
    Sums per range and a running sum over the ranges show in which range the source's budget ends;
    that range is sorted and summed row by row. A budget of more than the source repeats it whole
    first (``epochs``), then cuts the next epoch at ``rest`` words.
    """
    sized = scratch.put(docs.select("doc_id", "source", word_count("text").alias("size"),
                                    random_key("doc_id", seed).alias("_key")))
    targets = source_targets(sized, scratch, weights, share, most)
    budget = F.floor("target").cast("long")
    plan = scratch.put(targets.withColumn("_budget", budget)
                       .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
                           F.col("_budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
                       .withColumn("rest", F.col("_budget") - F.col("epochs") * F.col("source_size"))
                       .withColumn("_ranges", F.ceil(F.col("source_rows") / F.lit(range_rows)).cast("long")))
    small = plan.select("source", "rest", "_ranges").alias("p")
    ranged = (sized.alias("d").join(small, F.col("d.source").eqNullSafe(F.col("p.source")))
              .select("d.*", "p.rest", F.floor(_fraction("_key") * F.col("_ranges")).cast("long").alias("_range")))
    sums = ranged.groupBy("source", "rest", "_range").agg(F.sum("size").alias("_size"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    holds = scratch.put(sums.filter((F.col("_base") <= F.col("rest")) & (F.col("rest") < F.col("_base") + F.col("_size")))
                        .select("source", "_range", "_base"))
    last = (ranged.alias("r").join(holds.alias("h"), F.col("r.source").eqNullSafe(F.col("h.source"))
                                   & (F.col("r._range") == F.col("h._range")))
            .groupBy("r.source", "r._range", "h._base", "r.rest", "_key", "doc_id")
            .agg(F.sum("size").alias("_at_cut")))
    inside = (Window.partitionBy("source", "_range").orderBy("_key", F.col("doc_id").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    last = last.withColumn("_start", F.col("_base") + F.coalesce(F.sum("_at_cut").over(inside), F.lit(0)))
    cut = (last.filter((F.col("_start") <= F.col("rest")) & (F.col("rest") < F.col("_start") + F.col("_at_cut")))
           .select("source", F.col("_key").alias("_cut_key"), F.col("doc_id").alias("_cut_id"),
                   (F.col("rest") - F.col("_start")).alias("_left"), "_at_cut"))
    joined = plan.alias("p").join(cut.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    plan = joined.select("p.source", "source_size", "target", "epochs", "rest", "_cut_key", "_cut_id", "_left", "_at_cut")
    return sized, scratch.put(plan)


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds ``source_size, target, taken`` (words the mix takes, repeats counted) and ``epochs`` to the rows.

    Rows need ``doc_id, source, size, _key``. Rows of one id at a cut share what is left there.
    """
    joined = rows.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    at = (F.col("_key") == F.col("_cut_key")) & F.col("doc_id").eqNullSafe(F.col("_cut_id"))
    earlier = (F.col("_key") < F.col("_cut_key")) | ((F.col("_key") == F.col("_cut_key"))
                                                     & (F.col("doc_id") < F.col("_cut_id")))
    # a share of what is left at the cut, in whole words
    share = F.expr("CAST(floor(CAST(_left AS DECIMAL(19,0)) * size / _at_cut) AS BIGINT)")
    partial = (F.when(F.col("_cut_key").isNull() | (F.col("rest") <= 0), F.lit(0))
               .when(at, share).when(earlier, F.col("size")).otherwise(F.lit(0)))
    return joined.select("d.*", "p.source_size", "p.target", "p.epochs",
                         (F.col("epochs") * F.col("size") + partial).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: int = 1, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The mixed corpus, in the columns of ``docs``: each row as often as it is taken, the last epoch of a
    source cut at its budget, within a document if need be.

    Null text has size 0 and, like any row without words, is not in the mix. A null source is a
    source of its own, null ids share one key. Equal rows are separate rows. Other columns ride along;
    their names may not start with an underscore. An empty table gives an empty mix.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    _, plan = mix_plan(docs, scratch, weights, share, most, seed, range_rows)
    scratch.keep_only(plan)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source",
                        word_count("text").alias("size"), random_key("doc_id", seed).alias("_key"))
    taken = with_plan(inner, plan).filter(F.col("taken") > 0)
    whole = F.expr("transform(sequence(1, greatest(1, CAST(taken DIV size AS INT))), i -> size)")
    parts = F.when(F.col("taken") < F.col("size"), F.array("taken")).when(
        F.col("taken") % F.col("size") == 0, whole).otherwise(
        F.concat(whole, F.array(F.col("taken") % F.col("size"))))
    spread = taken.withColumn("_words", F.explode(parts))
    text = F.col("_row.text")
    pieces = F.split(text, rf"(?<=[^{SPACE}])(?=[{SPACE}])")
    begin = F.concat_ws("", F.slice(pieces, F.lit(1), F.col("_words").cast("int")))
    cut = F.when(F.col("_words") < F.col("size"), begin).otherwise(text)
    return spread.select(*[cut.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, targets and the words taken of every document."""
    scratch = Scratch(spark, "op1")
    sized, plan = mix_plan(table(spark, sf_dir, "documents"), scratch)
    return scratch.finish(with_plan(sized, plan).select("doc_id", "source", "size", "source_size", "target", "taken"))


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS s,
               [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3] AS w
        FROM sized GROUP BY source),
run AS (SELECT *, s * 2.0::DOUBLE AS cap, s * 2.0::DOUBLE / w AS ratio,
               sum(s) OVER () AS total, sum(w) OVER () AS ws,
               coalesce(sum(s) OVER before, 0) AS c, coalesce(sum(w) OVER before, 0) AS wb
        FROM per WINDOW before AS (ORDER BY s * 2.0::DOUBLE / w, source IS NULL, source
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (SELECT *, (CAST(total AS DOUBLE) * 1.5::DOUBLE - CAST(c AS DOUBLE) * 2.0::DOUBLE) / CAST(ws - wb AS DOUBLE) AS level FROM run),
tgt AS (SELECT source, s, CASE WHEN ratio <= level THEN cap
               ELSE w * (SELECT max(level) FROM lev WHERE NOT ratio <= level) END AS target FROM lev),
bud AS (SELECT *, CASE WHEN s > 0 THEN CAST(floor(target) AS BIGINT) // s ELSE 0 END AS e,
               CAST(floor(target) AS BIGINT) AS b FROM tgt),
pos AS (SELECT z.*, s, target, e, b - e * s AS rest,
               coalesce(sum(size) OVER (PARTITION BY z.source ORDER BY k, doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM sized z JOIN bud ON z.source IS NOT DISTINCT FROM bud.source)
SELECT doc_id, source, size, s AS source_size, target,
       CAST(e * size + least(size, greatest(0, rest - start)) AS BIGINT) AS taken FROM pos
"""
