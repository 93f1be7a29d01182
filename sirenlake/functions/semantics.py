"""Scalar semantics shared by all operators (null rules, rounding, text case, padding)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text spellings of a missing value after upper-casing.
MISSING_WORDS = ("NAN", "NONE", "")

# Every character that Unicode counts as white space.
SPACE_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col(c), F.lit(SPACE_CHARS))


def missing_to_null(c: Column) -> Column:
    """NULL for blank text and for the words that stand for a missing value."""
    return F.when(~F.upper(c).isin(*MISSING_WORDS), c)


def title_case(c: Column | str) -> Column:
    """Capitalise each letter that follows a non-letter (``initcap`` only looks at blanks)."""
    pieces = F.split(F.lower(col(c)), r"(?<=[^\p{L}])", -1)
    return F.array_join(F.transform(pieces, F.initcap), "")


def zero_pad(c: Column | str, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    c = col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def to_number(c: Column | str) -> Column:
    """Lenient number: NULL where the text is not one."""
    return strip(col(c).cast("string")).try_cast("double")


def round_even(c: Column, digits: int) -> Column:
    """Scale, round half to even, scale back."""
    factor = F.lit(float(10**digits))
    return F.rint(c * factor) / factor


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL for a zero or missing denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def count_where(cond: Column) -> Column:
    """Rows where the condition holds (0, not NULL, when there are none)."""
    return F.count(F.when(cond, 1))


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Grouping ignores rows with a missing key."""
    return df.na.drop(subset=list(keys))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def unnest(df: DataFrame, keep: Sequence[str], items: Column | str, value: str, position: str = "position") -> DataFrame:
    """One row per array element with its 0-based position; empty arrays give no row.

    The outer form keeps the optimiser from repeating a costly array expression in a filter
    below the generator; the rows it adds for empty arrays are dropped afterwards.
    """
    rows = df.select(*keep, F.posexplode_outer(col(items)).alias(position, value))
    return rows.where(F.col(position).isNotNull())
