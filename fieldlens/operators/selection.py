"""Exact quantiles by selection: brackets around each wanted rank are narrowed by counting, nothing is sorted.

A value is mapped to a 64-bit whole number of the same order. The first pass counts the values of each group by
their leading 16 bits, which tells in which bracket each wanted rank lies; the next pass counts only the values in
those brackets by 16 more bits, and so on, so that after four passes at most every rank is one value. A bracket
whose least and greatest value agree is done earlier. Counts combine before they are shuffled, so values never
are, and a hot group costs each pass one small row per bracket and task.

What a pass hands to the next is one row per group and rank, written, so that its size is known: Spark sends it to
all tasks where it is small, else it joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators.ranking import places
from fieldlens.session import stage

DIGIT = 16


def ordered_bits(value: Column) -> Column:
    """A 64-bit whole number of the same order as the double; -0.0 as 0.0, NULL for NaN and NULL.

    It is the number's binary form: exponent and fraction of the magnitude, the whole negated for negative values.
    The logarithm may miss the exponent by one, which the two comparisons set right; all else is exact.
    """
    x = F.when(~F.isnan(value), value)
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    low = F.when(size < F.pow(F.lit(2.0), guess), guess - 1).otherwise(guess)
    exponent = F.when(size >= F.pow(F.lit(2.0), low + 1), low + 1).otherwise(low)
    half = F.call_function("div", exponent, F.lit(2))  # 2 to the power of the whole may not be a double
    scaled = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half)
    normal = F.shiftleft((exponent + 1023).cast("bigint"), 52) + ((scaled - 1) * 2.0**52).cast("bigint")
    tiny = (size * 2.0**537 * 2.0**537).cast("bigint")  # below the least normal number
    bits = F.when(size == 0, F.lit(0).cast("bigint")).when(size == float("inf"), F.lit(2047 << 52)).when(size < 2.0**-1022, tiny).otherwise(normal)
    return F.when(x < 0, -bits).when(x.isNotNull(), bits)


def _wanted(totals: DataFrame, quantiles: Mapping[str, tuple[int, int]], kind: str) -> DataFrame:
    """(_group, place) of every rank that some quantile needs."""
    both = [place for p in quantiles.values() for place in places(kind, p, F.col("n"))[:2]]
    return totals.where("n > 0").select("_group", F.explode(F.array_distinct(F.array(*both))).alias("place"))


def select_ranks(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_group, place, value): the value at each wanted rank (1-based) of each group.

    ``rows`` is a written table of (_group, _bits, _value); ``wanted`` has (_group, place).
    """
    # before: rows of the group below the bracket; bracket: the leading bits all its values share.
    open_ = stage(wanted.select("_group", "place", F.lit(0).cast("bigint").alias("before"), F.lit(0).cast("bigint").alias("bracket")), "wanted")
    done = []
    for shift in range(64 - DIGIT, -1, -DIGIT):
        digit = F.shiftright("_bits", shift)
        inside = rows.withColumn("_bracket", F.shiftright("_bits", shift + DIGIT) if shift + DIGIT < 64 else F.lit(0).cast("bigint"))
        brackets = open_.select("_group", F.col("bracket").alias("_bracket")).distinct()
        counts = inside.join(brackets, ["_group", "_bracket"]).groupBy("_group", "_bracket", digit.alias("_digit")).agg(
            F.count("*").alias("_count"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
        upto = Window.partitionBy("_group", "_bracket").orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = counts.withColumn("_through", F.sum("_count").over(upto))  # 2^16 rows of a bracket at most
        joined = running.join(open_.withColumnRenamed("bracket", "_bracket"), ["_group", "_bracket"])
        rank = F.col("place") - F.col("before")
        hit = joined.where((F.col("_through") - F.col("_count") < rank) & (rank <= F.col("_through")))
        found = stage(hit.select("_group", "place", (F.col("before") + F.col("_through") - F.col("_count")).alias("before"),
                                 F.col("_digit").alias("bracket"), "_least", "_most"), "brackets")
        done.append(found.where("_least = _most").select("_group", "place", F.col("_least").alias("value")))
        open_ = found.where("_least < _most").select("_group", "place", "before", "bracket")
        if open_.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def selected_quantiles(rows: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, tuple[int, int]], kind: str = "linear",
                       carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows, rows with a value, and exact quantiles of a numeric column per group; NULL and NaN are no values.

    ``doc_count`` counts all rows and ``carry`` maps names to expressions summed over all of them, as decimals of
    38 digits; a group without values has NULL quantiles, a table without rows gives none, also without keys.
    """
    number = F.col(value).cast("double") + 0.0
    extra = {f"_carry_{name}": expression.cast("decimal(28,0)") for name, expression in (carry or {}).items()}
    # Distinct columns only, under names of their own: keys may be called as anything.
    narrow = rows.select(F.struct(*keys).alias("_group") if keys else F.lit(0).alias("_group"), F.when(~F.isnan(number), number).alias("_value"), *[e.alias(n) for n, e in extra.items()])
    narrow = stage(narrow.withColumn("_bits", ordered_bits(F.col("_value"))), "narrow")
    totals = stage(narrow.groupBy("_group").agg(F.count("*").alias("doc_count"), F.count("_value").alias("n"), *[F.sum(n).alias(n) for n in extra]), "totals")
    found = stage(select_ranks(narrow.where("_value IS NOT NULL").select("_group", "_bits", "_value"), _wanted(totals, quantiles, kind)), "found")
    listed = found.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("_at"))  # two per quantile
    joined = totals.join(listed, "_group", "left")

    def quantile(p):
        low, high, share = places(kind, p, F.col("n"))
        a, b = F.element_at("_at", low), F.element_at("_at", high)
        return a + (b - a) * share

    columns = [F.col(n).alias(n.removeprefix("_carry_")) for n in extra]
    own = [F.col("_group")[k].alias(k) for k in keys]
    return joined.select(*own, "doc_count", "n", *columns, *[quantile(p).alias(name) for name, p in quantiles.items()])
