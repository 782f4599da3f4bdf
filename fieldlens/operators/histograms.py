"""Histograms and simple measurements as rows, their totals and the daily aggregate document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.documents import as_map, number, once
from fieldlens.functions.scalars import grid_bucket, uptime_bucket
from fieldlens.schema import (
    DIMENSIONS, DIMS_NAME, DIMS_VALID, DIMS_VALUE, HISTOGRAM_DDL, MEASURE_LAYOUT,
    MEASURE_PREFIX, MEASURE_STEP, NESTED_MEASURE_LAYOUT, OTHER_MEASURE_LAYOUT, OTHER_MEASURE_STEP,
)
from fieldlens.session import stage

NAME_ROW = ["hist_name", "sum", "bucket_count", "min_range", "max_range", "hist_type", "is_valid"]
VALUE_ROW = ["hist_name", "v", "count", *NAME_ROW[1:]]


# Leaves of one histogram or measure

COMPLETE = " and ".join(
    f"{c} is not null" for c in ("sum", "bucket_count", "min_range", "max_range", "hist_type", "buckets")
)


def _integer_key(key: Column) -> Column:
    return F.when(key.rlike(r"^[+-]?[0-9]+$"), key.try_cast("bigint"))


def _buckets(values: Column) -> Column:
    """Usable buckets of a histogram: integer key and numeric count."""
    pairs = F.transform(
        F.map_entries(values),
        lambda e: F.struct(_integer_key(e["key"]).alias("v"), number(e["value"], "double").alias("count")),
    )
    return F.filter(pairs, lambda p: p["v"].isNotNull() & p["count"].isNotNull())


def _validity(valid: Column) -> Column:
    """1 unless a ``valid`` leaf exists; then 1 only for the text true in any case."""
    is_true = F.lower(F.try_variant_get(valid, F.lit("$"), "string")) == "true"
    return F.when(valid.isNull() | is_true, 1).otherwise(0)


def _limits(hist: Column) -> Column:
    """The range of a histogram as an array, made once in a projection of its own for all who look into it."""
    return F.try_variant_get(hist["range"], F.lit("$"), "array<variant>")


def _histogram_columns(hist: Column, limits: Column) -> dict[str, Column]:
    """Typed leaves of a histogram; the row is usable when none of them is NULL. ``limits`` has its range, see :func:`_limits`."""
    def limit(i):
        value = F.coalesce(number(F.get(limits, F.lit(i)), "int"), F.lit(0))
        return F.when(F.array_size(limits) >= 2, value).when(limits.isNotNull(), 0)

    return {
        "sum": number(hist["sum"], "bigint"),
        "bucket_count": number(hist["bucket_count"], "int"),
        "min_range": limit(0),
        "max_range": limit(1),
        "hist_type": number(hist["histogram_type"], "int"),
        "is_valid": _validity(hist["valid"]),
    }


def _measure_layout(measure: Column, is_member: Column, i: int) -> Column:
    out = F.when(is_member, NESTED_MEASURE_LAYOUT[i])
    for name, layout in MEASURE_LAYOUT.items():
        out = out.when(measure == name, layout[i])
    return out.otherwise(OTHER_MEASURE_LAYOUT[i])


def _measure_columns(measure: Column, is_member: Column, value: Column) -> dict[str, Column]:
    return {
        "sum": value,
        "bucket_count": _measure_layout(measure, is_member, 0),
        "min_range": _measure_layout(measure, is_member, 1),
        "max_range": _measure_layout(measure, is_member, 2),
        "hist_type": _measure_layout(measure, is_member, 3),
        "is_valid": F.lit(1),
    }


def _measure_bucket(measure: Column, is_member: Column, value: Column) -> Column:
    out = F.when(is_member | (measure == "startupInterrupted"), value).when(
        measure == "uptime", uptime_bucket(value)
    )
    for name, step in MEASURE_STEP.items():
        _, low, high, _ = MEASURE_LAYOUT[name]
        out = out.when(measure == name, grid_bucket(value, low, high, step))
    _, low, high, _ = OTHER_MEASURE_LAYOUT
    return out.otherwise(grid_bucket(value, low, high, OTHER_MEASURE_STEP))


PART_DDL = "struct<is_measure: boolean, part: string, member: string, leaf: variant>"


def _part(is_measure: bool, part: Column, member: Column, leaf: Column) -> Column:
    return F.struct(
        F.lit(is_measure).alias("is_measure"), part.alias("part"), member.cast("string").alias("member"), leaf.alias("leaf")
    )


def _histogram_parts() -> Column:
    return F.transform(F.map_entries("histograms"), lambda e: _part(False, e["key"], F.lit(None), e["value"]))


def _measure_parts() -> Column:
    """One part per measure, or one per member of a measure that is an object."""
    def parts(e):
        members = F.transform(F.map_entries(as_map(e["value"])), lambda m: _part(True, e["key"], m["key"], m["value"]))
        return F.coalesce(members, F.array(_part(True, e["key"], F.lit(None), e["value"])))

    return F.flatten(F.transform(F.map_entries("simpleMeasurements"), parts))


# Row generators

def _all_entries(df: DataFrame, carry: Sequence[str | Column], histograms: bool = True,
                 measures: bool = True) -> DataFrame:
    """Every histogram and measure, usable or not, with the kept columns packed as ``_kept``."""
    none = F.array().cast(f"array<{PART_DDL}>")
    arrays = []
    if histograms:
        arrays.append(F.coalesce(_histogram_parts(), none))
    if measures:
        arrays.append(F.coalesce(_measure_parts(), none))
    # The kept columns travel as one value through the fan-out: one copy per row, not one per column.
    prepared = once(df, F.struct(*carry).alias("_kept"), F.concat(*arrays).alias("_parts"))
    rows = prepared.select("_kept", F.inline("_parts"))
    is_measure, is_member = F.col("is_measure"), F.col("member").isNotNull()
    typed = rows.select(
        "_kept", "is_measure", "part", "member",
        F.when(~is_measure, F.try_variant_get("leaf", F.lit("$"), HISTOGRAM_DDL)).alias("_hist"),
        F.when(is_measure, number(F.col("leaf"), "bigint")).alias("_number"),
    )
    typed = typed.withColumn("_limits", _limits(F.col("_hist")))
    of_hist = _histogram_columns(F.col("_hist"), F.col("_limits"))
    of_measure = _measure_columns(F.col("part"), is_member, F.col("_number"))
    measure_name = F.concat(
        F.lit(MEASURE_PREFIX), F.upper("part"), F.coalesce(F.concat(F.lit("_"), F.upper("member")), F.lit(""))
    )
    point = F.array(F.struct(
        _measure_bucket(F.col("part"), is_member, F.col("_number")).alias("v"), F.lit(1.0).alias("count")
    ))
    return once(
        typed, "_kept", "is_measure", F.size(F.col("_hist")["values"]).alias("_n_values"),
        F.when(is_measure, measure_name).otherwise(F.col("part")).alias("hist_name"),
        *[F.when(is_measure, of_measure[c]).otherwise(of_hist[c]).alias(c) for c in NAME_ROW[1:]],
        F.when(is_measure, point).otherwise(_buckets(F.col("_hist")["values"])).alias("buckets"),
    )


def entries(df: DataFrame, carry: Sequence[str | Column], histograms: bool = True,
            measures: bool = True) -> DataFrame:
    """One row per usable histogram or simple measure, with its usable buckets as an array.

    ``carry`` holds the columns to keep; the parsed parts are dropped before the rows fan out. Both
    kinds come from one explode, so a document is read once.
    """
    usable = _all_entries(df, carry, histograms, measures).where(COMPLETE)
    return usable.select("_kept.*", *NAME_ROW, "buckets")


def warnings(df: DataFrame, carry: Sequence[str | Column]) -> DataFrame:
    """How much :func:`entries` and the daily totals leave out, in one row.

    Histograms without a required part, measures and buckets that are no numbers, and usable entries
    with a NULL among the kept columns, which the totals cannot match.
    """
    kept = F.struct(*carry)
    # Told once per document, so that the kept columns themselves need not travel with its entries.
    any_null = F.exists(F.array(*[kept[c].cast("string") for c in df.select(*carry).columns]), lambda v: v.isNull())
    rows = _all_entries(df, [any_null.alias("any_null")])
    complete = F.expr(COMPLETE)
    return rows.agg(
        F.count_if(~F.col("is_measure") & ~complete).alias("bad_histograms"),
        F.count_if(F.col("is_measure") & ~complete).alias("bad_measures"),
        F.coalesce(
            F.sum(F.when(complete & ~F.col("is_measure"), F.col("_n_values") - F.size("buckets"))), F.lit(0)
        ).alias("bad_buckets"),
        F.count_if(complete & F.col("_kept")["any_null"]).alias("null_dimensions"),
    )


def by_name(df: DataFrame, carry: Sequence[str | Column]) -> DataFrame:
    """One row per histogram or simple measure of each document."""
    return entries(df, carry).drop("buckets")


def by_value(rows: DataFrame) -> DataFrame:
    """One row per bucket from :func:`entries`."""
    kept = [c for c in rows.columns if c != "buckets"]
    lead = [c for c in kept if c not in NAME_ROW]
    return rows.select(*kept, F.inline("buckets")).select(*lead, *VALUE_ROW)


def single_histogram(df: DataFrame, name: str, value: Column, carry: Sequence[str | Column]) -> DataFrame:
    """Non-empty buckets of one histogram, given as a VARIANT."""
    hist = F.try_variant_get(value, F.lit("$"), HISTOGRAM_DDL)
    prepared = once(df, *carry, hist.alias("_hist"))
    kept = [c for c in prepared.columns if c != "_hist"]
    typed = _histogram_columns(F.col("_hist"), F.col("_limits"))
    rows = once(
        prepared.withColumn("_limits", _limits(F.col("_hist"))), *kept, F.lit(name).alias("hist_name"), *[typed[c].alias(c) for c in NAME_ROW[1:]],
        _buckets(F.col("_hist")["values"]).alias("buckets"),
    )
    return by_value(rows.where(COMPLETE)).where(F.col("count") != 0)


def names(df: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Every histogram name and every prefixed measure name, whatever their content."""
    none = F.array().cast("array<string>")
    prefixed = F.transform(F.map_keys("simpleMeasurements"), lambda n: F.concat(F.lit(MEASURE_PREFIX), F.upper(n)))
    found = F.concat(F.coalesce(F.map_keys("histograms"), none), F.coalesce(prefixed, none))
    return df.select(*carry, F.explode(found).alias("hist_name"))


# Totals

def _exact_sum(value: Column) -> Column:
    """Sum of 64-bit numbers as a decimal, so that only the total must fit where it is cast."""
    return F.sum(value.cast("decimal(19,0)"))


def name_totals(rows: DataFrame, keys: Sequence[str] = DIMS_NAME) -> DataFrame:
    """Summed sums and document counts per name; a total beyond 64 bits is NULL, see :func:`unfit_totals`."""
    return rows.groupBy(*keys).agg(_exact_sum(F.col("sum")).try_cast("bigint").alias("sum_sum"), F.count("*").alias("doc_count"))


def unfit_totals(rows: DataFrame, keys: Sequence[str] = DIMS_NAME) -> DataFrame:
    """The names whose summed sum does not fit 64 bits, with the exact total."""
    summed = rows.groupBy(*keys).agg(_exact_sum(F.col("sum")).alias("sum_sum"), F.count("*").alias("doc_count"))
    return summed.where(F.col("sum_sum").isNotNull() & F.col("sum_sum").try_cast("bigint").isNull())


def value_totals(rows: DataFrame, keys: Sequence[str] = DIMS_VALUE) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.max("bucket_count").alias("bucket_count"),
        F.min("min_range").cast("bigint").alias("min_range"),
        F.max("max_range").cast("bigint").alias("max_range"),
        F.max("hist_type").alias("hist_type"),
        F.sum("count").alias("sum_count"),
    )


def join_name_value(names_df: DataFrame, values_df: DataFrame,
                    keys: Sequence[str] = DIMS_NAME) -> DataFrame:
    """Attach name totals to value totals; both sides are already aggregated, one to many.

    Rows with a NULL in any key match nothing, as in any equi-join.
    """
    right = names_df.select(
        *keys, F.col("sum_sum").alias("hist_name_sum"), F.col("doc_count").alias("hist_name_doc_count")
    )
    return values_df.join(right, list(keys), "inner")


def combined_totals(rows: DataFrame, exact: bool = False) -> DataFrame:
    """Totals per name and bucket from one pass over :func:`entries`; rows without a bucket hold those of the name.

    With ``exact`` the sum of a name stays a decimal, which 64 bits do not bound.

    Each entry contributes its buckets plus one marker row without a bucket that carries the sum of the
    histogram, so one aggregation gives both kinds of totals without parsing the documents twice.
    """
    no_bucket = F.array(F.struct(F.lit(None).cast("bigint").alias("v"), F.lit(None).cast("double").alias("count")))
    complete = rows.where(" and ".join(f"{c} is not null" for c in DIMS_NAME))
    points = complete.select(
        *DIMS_NAME, "sum", "bucket_count", "min_range", "max_range", "hist_type",
        F.inline(F.concat(no_bucket, "buckets")),
    )
    marker = F.col("v").isNull()
    name_sum = _exact_sum(F.when(marker, F.col("sum")))
    return points.groupBy(*DIMS_VALUE).agg(
        F.max("bucket_count").alias("bucket_count"),
        F.min("min_range").cast("bigint").alias("min_range"),
        F.max("max_range").cast("bigint").alias("max_range"),
        F.max("hist_type").alias("hist_type"),
        F.sum("count").alias("sum_count"),
        (name_sum if exact else name_sum.try_cast("bigint")).alias("hist_name_sum"),
        F.count(F.when(marker, 1)).alias("hist_name_doc_count"),
    )


def daily_totals(rows: DataFrame) -> DataFrame:
    """Value totals with the totals of their name; the rows are those of :func:`join_name_value`.

    The combined totals are written once. A name may have any number of buckets, so its totals are joined
    to them, which adaptive execution can split, and no task sorts a name's buckets.
    """
    totals = stage(combined_totals(rows), "totals")
    names = totals.where(F.col("v").isNull()).select(*DIMS_NAME, "hist_name_sum", "hist_name_doc_count")
    return totals.where(F.col("v").isNotNull()).drop("hist_name_sum", "hist_name_doc_count").join(names, DIMS_NAME)


# Aggregate document

def aggregate_documents(totals: DataFrame) -> DataFrame:
    """Fold daily totals into one nested document per dimension set.

    Metadata of a name are taken over all its buckets, and buckets are ordered by value. What is
    collected are totals, one per name and bucket, never source rows.
    """
    per_name = totals.groupBy(*DIMS_NAME).agg(
        F.sort_array(F.collect_list(F.struct("v", F.col("sum_count").try_cast("bigint").alias("n")))).alias("pairs"),
        F.max("hist_name_doc_count").alias("count"),
        F.max("hist_name_sum").alias("sum"),
        F.max("bucket_count").alias("bucket_count"),
        F.min("min_range").alias("low"),
        F.max("max_range").alias("high"),
        F.max("hist_type").alias("histogram_type"),
    )
    histogram = F.struct(
        F.transform("pairs", lambda p: F.array(p["v"], p["n"])).alias("values"),
        "count", "sum", "bucket_count", F.array("low", "high").alias("range"), "histogram_type",
    )
    folded = per_name.groupBy(*DIMS_VALID).agg(
        F.sort_array(F.collect_list("hist_name")).alias("histogram_names"),
        F.map_from_entries(F.collect_list(F.struct("hist_name", histogram.alias("h")))).alias("histograms"),
    )
    about = F.struct(
        "reason", F.col("product").alias("appName"), F.col("product_version").alias("appVersion"),
        F.col("product_channel").alias("appUpdateChannel"), "arch", F.col("os").alias("OS"),
        F.col("os_version").alias("version"), F.col("app_build_id").alias("appBuildID"),
        F.col("plat_build_id").alias("platformBuildID"), (F.col("is_valid") == 1).alias("valid"),
    )
    return folded.select(
        *DIMENSIONS, "is_valid", F.substring("d", 1, 6).alias("month"),
        F.to_json(
            F.struct(F.col("d").alias("date"), about.alias("info"), "histogram_names", "histograms")
        ).alias("agg_json"),
    )
