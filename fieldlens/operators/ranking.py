"""Exact ranks, quantiles and nearest-below lookups that never put a whole group into one task.

All of them need "how much weight lies before this row" within a group. A plain ordered window
sorts a group in one task, and one group may hold a third of the data. Here the distinct rows are
written once, range-partitioned, ranked inside each range, and shifted by the weight of the ranges
before it. The number of ranges follows the number of rows, so a small table is one range of the same
plan. Where the cuts lie only decides the balance; the ranks are exact for any choice of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, IntegralType

from fieldlens.session import stage

ROWS_PER_RANGE = 100_000
MOST_RANGES = 20_000  # of a table of any size; what lies before a range is found over one row per range


def cut_into_ranges(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
                    rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Write ``df``, a staged table, with ``_range``: within equal keys it never falls as the order columns rise.

    Rows with equal order columns, NULL among them, are told apart by a hash of the keys, so a value
    that many groups share is spread over ranges as well. Counting rows reads only file footers.
    """
    ranges = min(MOST_RANGES, max(1, -(-df.count() // rows_per_range)))
    spread = [F.xxhash64(*keys)] if keys else []
    return stage(df.repartitionByRange(ranges, *order, *spread).withColumn("_range", F.spark_partition_id()), "ranges")


def _grouped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Pack keys into one struct so that NULL keys form a group and join like any other."""
    if not keys:
        return df, []
    return df.withColumn("_group", F.struct(*keys)), ["_group"]


def without_nan(df: DataFrame, *values: str) -> DataFrame:
    """``df`` with NaN in the given columns as missing, which it is for all statistics here."""
    inexact = [v for v in values if isinstance(df.schema[v].dataType, FractionalType) and not isinstance(df.schema[v].dataType, DecimalType)]
    return df.withColumns({v: F.when(~F.isnan(v), F.col(v)) for v in inexact}) if inexact else df


def exact_sum(df: DataFrame, expression: Column) -> Column:
    """Sum of an expression over rows of ``df``: whole numbers as decimals of 38 digits, others as they are."""
    kind = df.select(expression.alias("_kind")).schema[0].dataType
    return F.sum(expression.cast("decimal(28,0)")) if isinstance(kind, (IntegralType, DecimalType)) else F.try_sum(expression)


def positions(counts: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str = "n",
              rows_per_range: int = ROWS_PER_RANGE, mean_of: str | None = None,
              staged: bool = False) -> DataFrame:
    """Add to each row of ``counts`` (distinct by keys and order) its place within its group:

    ``before`` and ``through`` (weight in front of and up to the row), ``total`` (weight of the
    group) and, with ``mean_of``, ``mean`` (weighted mean of that column). ``staged`` says that
    ``counts`` is a written table already.
    """
    rows = counts if staged else stage(counts, "counts")
    extra = ["mean"] if mean_of else []
    value = F.col(mean_of).cast("double") if mean_of else F.lit(0.0)
    upto = (Window.unboundedPreceding, Window.currentRow)
    cut, group = _grouped(cut_into_ranges(rows, order, keys, rows_per_range), keys)
    blocks = cut.groupBy(*group, "_range").agg(
        F.sum(weight).alias("_weight"), F.sum(value * F.col(weight)).alias("_moment")
    )
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        *group, "_range",
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_weight").over(whole).alias("total"),
        F.try_divide(F.sum("_moment").over(whole), F.sum("_weight").over(whole)).alias("mean"),
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(*upto)
    ranked = cut.withColumn("_running", F.sum(weight).over(inside)).join(blocks, [*group, "_range"])
    through = F.col("_offset") + F.col("_running")
    return ranked.select(
        *counts.columns, (through - F.col(weight)).alias("before"), through.alias("through"), "total", *extra
    )


def places(kind: str, p: tuple[int, int], total: Column) -> tuple[Column, Column, Column]:
    """Two 1-based places and the share of the second one, in exact integer arithmetic."""
    num, den = p
    last = F.greatest(total, F.lit(1))
    if kind == "average":        # mean of the two neighbours at a step, else the value there
        low = F.greatest(F.call_function("div", total * num + (den - 1), F.lit(den)), F.lit(1))
        high = F.least(F.call_function("div", total * num, F.lit(den)) + 1, last)
        return low, high, F.lit(0.5)
    if kind == "linear":         # linear interpolation between neighbours
        h = (total - 1) * num
        low = F.call_function("div", h, F.lit(den)) + 1
        return low, F.least(low + 1, last), F.pmod(h, F.lit(den)) / F.lit(float(den))
    raise ValueError(f"unknown quantile kind {kind!r}")


def counted_statistics(counts: DataFrame, keys: Sequence[str], value: str, weight: str,
                       quantiles: Mapping[str, tuple[int, int]], kind: str = "linear",
                       sums: Sequence[str] = (), staged: bool = False,
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Weight ``n``, mean, standard deviation and exact quantiles per group of a counted column.

    ``counts`` is distinct by keys and value; ``sums`` names further columns to add up per group.
    Probabilities are fractions ``(numerator, denominator)``. A sum of whole numbers beyond 64 bits is NULL.
    """
    placed = positions(counts, keys, [value], weight, rows_per_range, mean_of=value, staged=staged)
    picks, shares = [], {}
    for name, p in quantiles.items():
        low, high, shares[name] = places(kind, p, F.col("total"))
        for label, place in ((f"_{name}_low", low), (f"_{name}_high", high)):
            hit = (F.col("before") < place) & (place <= F.col("through"))
            picks.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(label))
    off = F.col(value).cast("double") - F.col("mean")

    def whole(name):
        total = exact_sum(placed, F.col(name))
        return F.try_sum(name) if isinstance(placed.schema[name].dataType, FractionalType) and not isinstance(placed.schema[name].dataType, DecimalType) else total.try_cast("bigint")

    out = placed.groupBy(*keys).agg(
        F.sum(weight).alias("n"), F.max("mean").alias("mean"), F.max("total").alias("total"),
        F.sum(F.col(weight) * off * off).alias("_squares"),
        *[whole(name).alias(name) for name in sums], *picks,
    )

    def quantile(name):
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * shares[name]).alias(name)

    deviation = F.sqrt(F.try_divide(F.col("_squares"), F.col("n") - 1))
    return out.select(*keys, "n", "mean", deviation.alias("sd"), *sums, *[quantile(q) for q in quantiles])


def value_counts(df: DataFrame, keys: Sequence[str], value: str, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows per group and distinct value: ``doc_count`` of all, ``n`` of those with a value, and the sums of ``carry``.

    NaN is no value. Sums of whole numbers are decimals, so that none is lost before the last total.
    """
    df = without_nan(df, value)
    counts = df.groupBy(*keys, value).agg(
        F.count("*").alias("doc_count"),
        *[exact_sum(df, expression).alias(name) for name, expression in (carry or {}).items()],
    )
    return counts.withColumn("n", F.when(F.col(value).isNull(), 0).otherwise(F.col("doc_count")))


def group_statistics(df: DataFrame, keys: Sequence[str], value: str,
                     quantiles: Mapping[str, tuple[int, int]], kind: str = "linear",
                     carry: Mapping[str, Column] | None = None, **options) -> DataFrame:
    """Statistics of ``value`` per group, missing values left aside.

    ``doc_count`` counts all rows of a group and ``carry`` maps names to expressions summed over all
    of them; ``n`` counts the rows with a value.
    """
    counts = value_counts(df, keys, value, carry)
    return counted_statistics(counts, keys, value, "n", quantiles, kind, ["doc_count", *(carry or {})], **options)


def distribution(df: DataFrame, value: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Empirical distribution function: the share of rows at or below each distinct value."""
    counts = without_nan(df, value).where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    return positions(counts, [], [value], rows_per_range=rows_per_range).select(
        value, "n", (F.col("through") / F.col("total")).alias("ecdf")
    )


def average_ranks(counts: DataFrame, value: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Average rank of each distinct value, ties sharing the mean of their places."""
    return positions(counts, [], [value], rows_per_range=rows_per_range).select(
        value, (F.col("before") + (F.col("n") + 1) / F.lit(2.0)).alias("rank"), "total"
    )


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "idx",
                rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Number the rows by a total order."""
    counted = df.withColumn("n", F.lit(1).cast("bigint"))
    placed = positions(counted, [], order, rows_per_range=rows_per_range)
    return placed.select(*df.columns, F.col("through").alias(name))


def nearest_below(points: DataFrame, marks: DataFrame, keys: Sequence[str], position: str,
                  mark_position: str, payload: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """For each distinct point the payload of the greatest mark at or below it with equal keys.

    ``points`` must be distinct by keys and position. Points without such a mark get NULL.
    """
    both = marks.select(
        *keys, F.col(mark_position).alias(position), F.lit(0).alias("_is_point"), payload
    ).unionByName(
        points.select(*keys, position, F.lit(1).alias("_is_point"), F.lit(None).cast("string").alias(payload))
    )
    rows = stage(both, "lookup")
    is_mark = F.col("_is_point") == 0
    order, upto = [position, "_is_point", payload], (Window.unboundedPreceding, Window.currentRow)
    cut, group = _grouped(cut_into_ranges(rows, [*keys, position], rows_per_range=rows_per_range), keys)
    blocks = cut.groupBy(*group, "_range").agg(
        F.max_by(payload, F.when(is_mark, F.struct(position, payload))).alias("_last")
    )
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*group, "_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(*upto)
    found = cut.withColumn("_here", F.last(payload, ignorenulls=True).over(inside)).where(~is_mark)
    return found.join(blocks, [*group, "_range"]).select(*keys, position, F.coalesce("_here", "_carry").alias(payload))
