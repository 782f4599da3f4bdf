"""Descriptive statistics over tables of measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.scalars import ratio, right_closed_bin
from fieldlens.operators.ranking import average_ranks, counted_statistics, group_statistics, without_nan
from fieldlens.session import stage

QUARTILES = {"q1": (1, 4), "median": (1, 2), "q3": (3, 4)}
MEDIAN = {"median": (1, 2)}


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("pearson"))


def spearman(df: DataFrame, x: str, y: str, **options) -> DataFrame:
    """Correlation of average ranks.

    Rows shrink to distinct pairs with a count, ranks are found on distinct values, and the mean
    rank is known from the total, so the last step is one aggregate.
    """
    pairs = without_nan(df, x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count("*").alias("n"))
    pairs = stage(pairs, "pairs")

    def ranked(column, name):
        counts = pairs.groupBy(column).agg(F.sum("n").alias("n"))
        return average_ranks(counts, column, **options).select(
            column, (F.col("rank") - (F.col("total") + 1) / 2).alias(name)
        )

    both = pairs.join(ranked(x, "_x"), x).join(ranked(y, "_y"), y)
    n, rx, ry = F.col("n"), F.col("_x"), F.col("_y")
    together = F.sum(n * rx * ry)
    return both.agg(
        F.try_divide(together, F.sqrt(F.sum(n * rx * rx)) * F.sqrt(F.sum(n * ry * ry))).alias("spearman")
    )


def six_numbers(df: DataFrame, keys: Sequence[str], value: str, **options) -> DataFrame:
    """Minimum, quartiles, mean, maximum, and the number of missing values, NaN among them."""
    df = without_nan(df, value)
    stats = group_statistics(
        df, keys, value, {"min": (0, 1), **QUARTILES, "max": (1, 1)},
        carry={"missing": F.when(F.col(value).isNull(), 1).otherwise(0)}, **options,
    )
    return stats.select(*keys, F.col("n").alias("n_values"), "min", "q1", "median", "mean", "q3", "max", "missing")


def bins(df: DataFrame, keys: Sequence[str], value: str, low: float, high: float, step: float) -> DataFrame:
    """Histogram with right-closed bins of one width and open ends down to the least and up to the
    greatest value; the first bin holds its lower end. Density is the share per unit of width.
    """
    x = F.col(value)
    upper = F.when(x <= low, F.lit(float(low))).when(x > high, F.lit(float("inf"))).otherwise(
        right_closed_bin(x.cast("double"), float(low), float(step))
    )
    counted = without_nan(df, value).where(x.isNotNull()).groupBy(*keys, upper.alias("_upper")).agg(
        F.count("*").alias("n"), F.min(value).alias("_least"), F.max(value).alias("_most")
    )
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    lower = F.when(F.col("_upper") == low, F.col("_least")).when(
        F.col("_upper") == float("inf"), F.lit(float(high))
    ).otherwise(F.col("_upper") - step)
    top = F.when(F.col("_upper") == float("inf"), F.col("_most")).otherwise(F.col("_upper"))
    with_edges = counted.select(
        *keys, lower.cast("double").alias("lower"), top.cast("double").alias("upper"), "n",
        F.sum("n").over(whole).alias("_total"),
    )
    return with_edges.select(
        *keys, "lower", "upper", "n",
        F.try_divide(F.col("n"), F.col("_total") * (F.col("upper") - F.col("lower"))).alias("density"),
    )


def min_max_scaled(df: DataFrame, value: str, name: str) -> DataFrame:
    """Map the value range to 0..1; the two limits are one scalar subquery each."""
    least = df.agg(F.min(value)).scalar()
    most = df.agg(F.max(value)).scalar()
    return df.withColumn(name, ratio(F.col(value) - least, most - least))


def two_level_average(df: DataFrame, inner: Sequence[str], outer: Sequence[str], value: str, weight: str,
                      **options) -> DataFrame:
    """Weighted average per inner group, then mean and median of those per outer group."""
    per_inner = df.groupBy(*inner).agg(
        F.sum(weight).alias("sum_count"), F.sum(F.col(value) * F.col(weight)).alias("sum_time")
    ).withColumn("avg_time", ratio(F.col("sum_time"), F.col("sum_count")))
    stats = group_statistics(
        per_inner, outer, "avg_time", MEDIAN, carry={"sum_count": F.col("sum_count")}, **options
    )
    return stats.select(
        *outer, F.col("mean").alias("avg_time"), F.col("median").alias("median_time"), "sum_count"
    )


def kernel_density(df: DataFrame, value: str, points: int = 512, cut: float = 3.0, **options) -> DataFrame:
    """Gaussian kernel density on a regular grid.

    Bandwidth by the usual rule of thumb (0.9 times the lesser of standard deviation and
    interquartile range / 1.34, times n to the power -1/5). Values are first spread linearly over
    the cells of a fixed grid, so the data is read once for the limits and once for the weights;
    the smoothing then works on that one fixed-size row, whatever the size of the data. Without values
    there is no curve and no row.
    """
    counts = stage(
        without_nan(df, value).where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_count")), "values"
    )
    spread = counted_statistics(
        counts, [], value, "_count", {"min": (0, 1), **QUARTILES, "max": (1, 1)}, staged=True, **options
    )
    deviation, iqr = F.col("sd"), (F.col("q3") - F.col("q1")) / 1.34
    least = F.least(deviation, iqr)
    scale = F.when(least > 0, least).when(deviation > 0, deviation).otherwise(F.lit(1.0))
    limits = spread.select(
        "n", "min", "max", (0.9 * scale * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bw")
    ).select(
        "n", "bw", (F.col("min") - cut * F.col("bw")).alias("from"), (F.col("max") + cut * F.col("bw")).alias("to"),
    )
    # One row of four numbers: safe to bring in as a scalar.
    packed = limits.select(F.struct(
        "n", "bw", "from", "to", (F.col("from") - 4 * F.col("bw")).alias("lo"),
        ((F.col("to") - F.col("from") + 8 * F.col("bw")) / (points - 1)).alias("delta"),
    ).alias("g")).scalar()

    placed = counts.withColumn("_at", (F.col(value) - packed["lo"]) / packed["delta"])
    cell, share = F.floor("_at").cast("int"), F.col("_at") - F.floor("_at")
    weights = (
        placed.select(F.inline(F.array(
            F.struct(cell.alias("cell"), ((1 - share) * F.col("_count")).alias("w")),
            F.struct((cell + 1).alias("cell"), (share * F.col("_count")).alias("w")),
        )))
        .groupBy("cell").agg(F.sum("w").alias("w"))
    )
    row = weights.agg(F.collect_list(F.struct("cell", "w")).alias("cells")).where(F.size("cells") > 0).withColumn("g", packed)
    g = F.col("g")

    def smoothed(i):
        def term(total, c):
            z = (i - c["cell"]) * g["delta"] / g["bw"]
            return total + c["w"] * F.exp(-0.5 * z * z)
        return F.aggregate("cells", F.lit(0.0), term) / (g["n"] * g["bw"] * F.sqrt(2 * F.pi()))

    curve = row.select("g", F.transform(F.sequence(F.lit(0), F.lit(points - 1)), smoothed).alias("y"))
    grid = curve.select("g", "y", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = g["from"] + F.col("i") * (g["to"] - g["from"]) / (points - 1)
    at = (x - g["lo"]) / g["delta"]
    left = F.least(F.floor(at).cast("int"), F.lit(points - 2))
    y0, y1 = F.get("y", left), F.get("y", left + 1)
    return grid.select("i", x.alias("x"), (y0 + (y1 - y0) * (at - left)).alias("density"))
