"""Exact continuous median per group (``percentile_cont(0.5)``) by digit selection.

Spark's ``percentile`` keeps a value->count map of a whole group in one task's
memory and returns a double.  Here values are whole cents, and

1. (group, value) -> count: partial aggregation before the shuffle, which is keyed by the
   value too, so a hot group is spread out;
2. (group, leading digits) -> rows and the (value, count) list of that digit range.  Leading digits
   are those of a floating-point number of ``DIGIT_BITS`` bits: a group has at most a few
   thousand ranges whatever its prices, and a range holds values that differ by a 128th;
3. a running count over a group's ranges tells which range holds position floor((n-1)/2)
   and which holds floor(n/2), and only the lists of those one or two are put in order;
4. the two values are averaged exactly and rounded half away from zero.

Nothing is joined and nothing is approximated.  It equals ``round(percentile_cont(0.5) ...
::numeric, scale)`` without the double round trip (T15).  ``leading_digits``, ``value_list`` and
``middle`` are the parts, for aggregates that carry other measures along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions._col import col
from lodgelake.functions.numeric import cents, cents_ratio

#: Bits of a value's magnitude that name its digit range.
DIGIT_BITS = 8


def leading_digits(value) -> Column:
    """Number of the digit range of a whole number; greater values never have smaller numbers."""
    v = col(value)
    size = F.abs(v)
    shift = F.greatest(F.length(F.bin(size)) - DIGIT_BITS, F.lit(0))
    digits = shift * (1 << (DIGIT_BITS - 1)) + F.call_function("shiftright", size, shift)
    return F.when(v < 0, -digits).otherwise(digits)


def value_list(value, n) -> Column:
    """Aggregate: the (value, count) pairs of a digit range; null values are left out."""
    v, c = col(value), col(n)
    return F.collect_list(F.when(v.isNotNull(), F.struct(v.cast("bigint").alias("v"), c.cast("bigint").alias("c"))))


def _nth(values: Column, k: Column) -> Column:
    """The value at place ``k`` (from 0) of a (value, count) list in order of value."""
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("v"))

    def step(a: Column, x: Column) -> Column:
        upto = a["seen"] + x["c"]
        return F.struct(upto.alias("seen"), F.when((a["seen"] <= k) & (k < upto), x["v"]).otherwise(a["v"]).alias("v"))

    return F.aggregate(F.array_sort(values), start, step)["v"]


def middle(group: Sequence[str], digits: str, n: str, values: str) -> tuple[Column, Column]:
    """The lower and upper middle value of each group, in the row of the digit range that holds it, else null."""
    whole = Window.partitionBy(*group)
    rows = F.coalesce(F.col(n), F.lit(0)).cast("bigint")
    upto = F.sum(rows).over(whole.orderBy(digits).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum(rows).over(whole)

    def at(place: Column) -> Column:
        first = upto - rows
        return F.when((first <= place) & (place < upto), _nth(F.col(values), place - first))

    return at(F.call_function("div", total - 1, F.lit(2))), at(F.call_function("div", total, F.lit(2)))


def exact_median(df: DataFrame, group_cols: Sequence[str], value, out_col: str = "median",
                 scale: int = 2, where: Column | None = None) -> DataFrame:
    """Median of a decimal of ``scale`` fractional digits, rounded to as many; null values do not count."""
    g = list(group_cols)
    v = col(value) if where is None else F.when(where, col(value))
    counted = (df.select(*g, cents(v, scale).alias("_v")).where(F.col("_v").isNotNull())
               .groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c")))
    ranges = counted.groupBy(*g, leading_digits("_v").alias("_d")).agg(F.sum("_c").alias("_n"), value_list("_v", "_c").alias("_values"))
    low, high = middle(g, "_d", "_n", "_values")
    return (ranges.select(*g, low.alias("_low"), high.alias("_high")).groupBy(*g)
            .agg(cents_ratio(F.max("_low") + F.max("_high"), F.lit(2), scale).alias(out_col)))
