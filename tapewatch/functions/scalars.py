"""Column expressions; all but ``euclidean``, which takes arrays, stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewatch.schema import ANOMALOUS, NORMAL, TIMESTAMP_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def once(c: Column) -> Column:
    """Use as a select item for a costly expression that later columns and filters refer to.

    Catalyst would copy the expression into every filter it pushes down; it does not push filters
    on a generated column through its generator.
    """
    return F.explode(F.array(c))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den, and 0.0 when the denominator is zero or null."""
    num, den = _col(num), _col(den)
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def or_default(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def label_when(cond: Column, yes, no) -> Column:
    """yes where cond holds; a null condition counts as no."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def label_text(flag: Column | str) -> Column:
    return label_when(_col(flag) == 1, ANOMALOUS, NORMAL)


def number(c: Column | str) -> Column:
    """Text to double at the decode edge: bad text, NaN and infinities become null instead of an error."""
    return finite(_col(c).try_cast("double"))


def finite(c: Column | str) -> Column:
    """Null in place of NaN and infinities."""
    c = _col(c)
    return F.when(F.abs(c) < float("inf"), c)  # NaN compares as larger than all


#: the largest size of ``order_code``, that of NaN
LARGEST_CODE = (2047 << 52) + 1


def order_code(c: Column | str) -> Column:
    """A double as a long of the same order, from its sign, exponent and mantissa.

    Scaling by powers of two is exact, so different numbers have different codes; both zeros have one. Infinities lie
    beyond all numbers and NaN beyond them, as Spark sorts it. Null stays null.
    """
    x = _col(c).cast("double")
    size = F.abs(x)
    two = F.lit(2.0)
    guess = F.floor(F.log2(size)).cast("double")  # may be off by one next to a power of two
    exponent = F.when(size < F.pow(two, guess), guess - 1).when(size >= F.pow(two, guess + 1), guess + 1).otherwise(guess)
    exponent = F.greatest(exponent, F.lit(-1022.0))
    mantissa = (size / F.pow(two, exponent) * F.lit(float(1 << 52))).cast("long")
    code = (exponent + 1022).cast("long") * F.lit(1 << 52) + mantissa
    code = (F.when(F.isnan(x), F.lit(LARGEST_CODE)).when(size == float("inf"), F.lit(LARGEST_CODE - 1))
            .when(size == 0, F.lit(0)).otherwise(code))
    return F.when(x.isNull(), F.lit(None).cast("long")).when((x < 0), -code).otherwise(code)


def whole_number(c: Column | str) -> Column:
    return _col(c).try_cast("long")


def text(c: Column | str) -> Column:
    return _col(c).cast("string")


def sigmoid(x: Column | str) -> Column:
    """1 / (1 + e^-x) without overflow for large negative x."""
    x = _col(x)
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Distance of two numeric arrays of equal length."""
    squares = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))


def squared_distance_to(columns: Sequence[Column | str], point: Sequence[float]) -> Column:
    terms = [(_col(c) - F.lit(float(p))) * (_col(c) - F.lit(float(p))) for c, p in zip(columns, point)]
    return reduce(lambda x, y: x + y, terms)


def fmt_ts(c: Column | str, pattern: str = TIMESTAMP_PATTERN) -> Column:
    return F.date_format(_col(c), pattern)


def parse_ts(c: Column | str, pattern: str = TIMESTAMP_PATTERN) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(pattern))


def iso_ts(ms: Column | str) -> Column:
    """Epoch milliseconds to ISO text in UTC, e.g. 2024-01-01T00:00:07.179+00:00."""
    return F.date_format(F.timestamp_millis(_col(ms)), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(_col(c))


def norm_symbol(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def unpack_vector(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Replace an ML vector column by one double column per element."""
    parts = vector_to_array(F.col(column))
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, *[parts.getItem(i).alias(n) for i, n in enumerate(names)])
