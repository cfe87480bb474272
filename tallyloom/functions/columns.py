"""Column expressions: trimming, tolerant parsing, bands, margins and stable hash keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Discount bands, closed on the right.
DISCOUNT_EDGES = (-0.001, 0.0, 0.2, 0.4, 1.0)
DISCOUNT_LABELS = ("No discount", "Low discount", "Medium discount", "High discount")

# Quantity groups, closed on the right.
QUANTITY_EDGES = (0, 5, 10, 100)
QUANTITY_LABELS = ("Low", "Medium", "High")


def strip(column: Column) -> Column:
    """Trim every kind of white space from both ends."""
    return F.btrim(column, F.lit(WHITESPACE))


def parse_number(column: Column, data_type: str) -> Column:
    """Text with thousands commas to a number; anything unreadable becomes NULL."""
    return F.replace(strip(column), F.lit(","), F.lit("")).try_cast(data_type)


def parse_day_first(column: Column) -> Column:
    """Day-first dates in slash or dash form; anything unreadable becomes NULL."""
    text = strip(column)
    readings = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in ("d/M/yyyy", "d-M-yyyy")]
    return F.coalesce(*readings).cast("date")


def band(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval the value falls in; NULL outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    value = column.cast("double")
    ladder = F.when(value <= float(edges[0]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        ladder = ladder.when(value <= float(edge), F.lit(label))
    return ladder


def margin(profit: Column, sales: Column) -> Column:
    """Profit over sales, 0 where there are no positive sales."""
    return F.when(sales > 0, profit.cast("double") / sales.cast("double")).otherwise(F.lit(0.0))


def signed_log(column: Column) -> Column:
    """Logarithm that keeps the sign and is defined at zero."""
    value = column.cast("double")
    return F.signum(value) * F.log1p(F.abs(value))


def hash_key(*columns: Column | str) -> Column:
    """128-bit text hash of the given columns: uniform, so its leading digits make equal-sized buckets."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def one_row(frame: DataFrame) -> Column:
    """A one-row aggregate as a struct that other queries can refer to (scalar subquery, computed once)."""
    return frame.select(F.struct(*frame.columns)).scalar()


def is_one_of(column: Column, values: Sequence) -> Column:
    """Membership in a list; an empty list matches nothing."""
    return column.isin(list(values)) if len(values) else F.lit(False)
