"""Small table-shaping helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, struct_col: str) -> DataFrame:
    """Lift the fields of a struct to the top level and drop the struct."""
    others = [F.col(c) for c in df.columns if c != struct_col]
    return df.select(*others, f"{struct_col}.*")


def drop_cols(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def dropna(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(subset))


def sort_by(df: DataFrame, *columns) -> DataFrame:
    return df.orderBy(*columns)


def top_by_key(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    return df.orderBy(key).limit(n)


def newest(df: DataFrame, ts: str, n: int = 1, tiebreak: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak]).limit(n)


def union_batches(*frames: DataFrame) -> DataFrame:
    """Same columns, any order; duplicates kept."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def union_loose(*frames: DataFrame) -> DataFrame:
    """Different columns allowed; what a side lacks is null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def distinct_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def _moment(at: datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def seconds_before(at: datetime | Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(_moment(at)) - F.lit(seconds * 1_000_000))


def recent(df: DataFrame, asof: datetime | Column, seconds: int, ts: str = "event_time") -> DataFrame:
    """Rows of the last ``seconds`` up to and including ``asof``; never the wall clock."""
    return df.filter((F.col(ts) >= seconds_before(asof, seconds)) & (F.col(ts) <= _moment(asof)))
