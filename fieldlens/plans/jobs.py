"""The jobs users run, composed from the operators. Each takes submissions ``(k, d, json)``.

Product names are parameters: every deployment has its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.functions import scalars as sf
from fieldlens.functions.documents import (
    PRESENCE, dimension_columns, info, is_complete, is_present, parse, parse_whole, select_fields,
)
from fieldlens.functions.predicates import drop_incomplete, from_products, where_all
from fieldlens.operators import hangs, histograms, slowsql, statistics, validation
from fieldlens.operators.ranking import distribution, group_statistics, row_numbers
from fieldlens.schema import DEFAULT_REASONS, MISSING
from fieldlens.session import splits_of, stage
from fieldlens.sources.submissions import in_date_range, write_store

MEDIAN = {"median": (1, 2)}
FLASH_KEYS = ["product", "product_version", "product_channel", "os", "os_version", "flash_version"]
OOM_HISTOGRAM = "OUT_OF_MEMORY_KILLED"
OOM_KEYS = [
    "d", "reason", "product_version", "product_channel", "arch", "has_armv6", "has_armv7", "os",
    "os_version", "normalized_kernel_version", "kernel_version", "has_oom_killed",
]


def complete_submissions(submissions: DataFrame, products: Sequence[str],
                         reasons: Sequence[str] = DEFAULT_REASONS, os: str | None = None, **typed: str) -> DataFrame:
    """Keys of the given products' submissions that hold all three main parts, with these as columns.

    ``typed`` names how to read a part; jobs that only need it to be there say so.
    """
    parts = [p for p in ("info", "histograms", "simpleMeasurements") if p not in typed]
    return parse(submissions, *parts, keep=["k"], **typed).where(is_complete() & from_products(products, reasons, os))


# Histograms

def histogram_rows(submissions: DataFrame, products: Sequence[str]) -> DataFrame:
    """One row per histogram and simple measure with the ten dimensions and its buckets."""
    return histograms.entries(complete_submissions(submissions, products), dimension_columns())


def daily_aggregates(submissions: DataFrame, products: Sequence[str]) -> DataFrame:
    return histograms.daily_totals(histogram_rows(submissions, products))


def aggregate_documents(submissions: DataFrame, products: Sequence[str]) -> DataFrame:
    return histograms.aggregate_documents(daily_aggregates(submissions, products))


def validated_aggregates(submissions: DataFrame, spec: DataFrame, products: Sequence[str]) -> DataFrame:
    """Validation first, then aggregation of the validated documents."""
    valid = validation.validate(submissions, spec)
    return aggregate_documents(valid.select("k", "json"), products)


# Validation and privacy

def validate_submissions(submissions: DataFrame, spec: DataFrame) -> DataFrame:
    """All submissions, each document replaced by its validated form where it has one.

    The new document comes from the row it replaces, so the write-back needs no join.
    """
    judged = validation.with_validated(submissions, spec)
    return judged.select("k", "d", F.coalesce("new_json", "json").alias("json"))


VALIDATION_SPLIT = 16 << 20  # bytes of a compressed store for one task


def validate_store(submissions: DataFrame, spec: DataFrame, path: str) -> DataFrame:
    """Write all submissions, validated, into the store at ``path`` and return the counters of the run, one row.

    Documents are read once, and every task writes what it read, without a shuffle: submissions that come from a
    store lie together by day already. Documents compress well and take long, so a task reads few bytes of them.
    """
    judged, seen = validation.observed(submissions, spec)
    with splits_of(submissions.sparkSession, VALIDATION_SPLIT):
        write_store(judged.select("k", "d", F.coalesce("new_json", "json").alias("json")), path, rebalance=False)
    found = seen.get
    names = ["documents", *validation.DOCUMENT_COUNTERS, *validation.HISTOGRAM_COUNTERS]
    return submissions.sparkSession.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def scrub_submissions(submissions: DataFrame, compat: bool = False) -> DataFrame:
    """All submissions with private literals masked in recorded SQL, without a join as above."""
    rewritten = slowsql.with_scrubbed(submissions, compat)
    return rewritten.select("k", "d", F.coalesce("new_json", "json").alias("json"))


def count_valid_invalid(submissions: DataFrame) -> DataFrame:
    verdict = info("validForSchema")
    return parse(submissions, "info", keep=[]).agg(
        F.count("*").alias("all_docs"), F.count_if(verdict == "true").alias("valid_docs"),
        F.count_if(verdict == "false").alias("invalid_docs"),
    )


# Slow SQL

def slow_sql_rows(submissions: DataFrame, threads: Sequence[str] = slowsql.THREADS, scrub: bool = False) -> DataFrame:
    """Statement rows with the report's dimensions; ``scrub`` masks private literals on the way."""
    carry = [
        sf.day_from_key(F.col("k")).alias("d"), info("appName").alias("product"),
        info("appVersion").alias("product_version"), info("appUpdateChannel").alias("product_channel"),
    ]
    return slowsql.statements(parse(submissions, "info", "slowSQL", keep=["k"]), carry, threads, scrub)


def slow_sql_report(submissions: DataFrame, min_docs: int = 100, scrub: bool = False, **options) -> DataFrame:
    """Both threads in one pass; statements recorded more than ``min_docs`` times, most frequent first.

    With ``scrub`` private literals are masked first, for submissions that were not scrubbed when they were stored.
    """
    report = slowsql.quantile_report(slow_sql_rows(submissions, scrub=scrub), min_docs=min_docs, **options)
    return report.orderBy(
        "thread", F.desc("doc_count"), F.desc("sum_count"), *slowsql.REPORT_KEYS[1:]
    )


# Counts by configuration

def flash_versions(submissions: DataFrame, products: Sequence[str], os: str | None = None) -> DataFrame:
    rows = complete_submissions(submissions, products, os=os, **PRESENCE).select(
        *dimension_columns(FLASH_KEYS[:-1]), sf.null_default(info("flashVersion"), MISSING).alias("flash_version")
    )
    return rows.groupBy(*FLASH_KEYS).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"))


def oom_killed_counts(submissions: DataFrame, products: Sequence[str]) -> DataFrame:
    version = info("version")
    kept = complete_submissions(
        submissions, products, histograms=f"struct<{OOM_HISTOGRAM}: variant>",
        simpleMeasurements=PRESENCE["simpleMeasurements"],
    )
    rows = kept.select(
        *dimension_columns(["d", "reason", "product_version", "product_channel", "arch"]),
        sf.flag(info("hasARMv6") == "true").alias("has_armv6"),
        sf.flag(info("hasARMv7") == "true").alias("has_armv7"), info("OS").alias("os"),
        sf.kernel_release(version).alias("os_version"),
        sf.kernel_version(version).alias("normalized_kernel_version"), version.alias("kernel_version"),
        sf.flag(is_present(F.col("histograms")[OOM_HISTOGRAM])).alias("has_oom_killed"),
    )
    return rows.groupBy(*OOM_KEYS).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"))


def count_by_version(submissions: DataFrame, products: Sequence[str]) -> DataFrame:
    kept = parse(submissions, "info", keep=[]).where(
        info("appName").isin(*products) & info("appVersion").isNotNull()
    )
    return kept.groupBy(info("appVersion").alias("product_version")).agg(F.count("*").alias("cnt"))


def submission_stats(submissions: DataFrame, by_product: bool = False) -> DataFrame:
    """Number and size of submissions per day, optionally per product and version."""
    size = sf.text_size(F.col("json")).alias("json_size")
    day = sf.day_from_key(F.col("k")).alias("d")
    if by_product:
        keys = ["d", "product", "product_version"]
        rows = parse(submissions, "info").select(
            day, info("appName").alias("product"), info("appVersion").alias("product_version"), size
        )
    else:
        keys, rows = ["d"], submissions.select(day, size)
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("count"), F.sum("json_size").alias("sum_size"), F.avg("json_size").alias("avg_size")
    )
    return stats.orderBy(*(["product", "product_version", "d", "count"] if by_product else ["d"]))


# Hangs

def hang_submissions(submissions: DataFrame) -> DataFrame:
    return hangs.select_hangs(submissions).select("k", "json")


def hang_report(submissions: DataFrame, symbols: DataFrame, **options) -> DataFrame:
    return hangs.hang_report(submissions, symbols, **options)


# Ad-hoc queries

def adhoc_query(submissions: DataFrame, start: str, end: str, terms: Sequence[tuple] = (),
                sample: float | None = None, fields: Sequence[str] = ()) -> DataFrame:
    """Date range, predicates, repeatable sample and projected fields, in that order."""
    rows = in_date_range(submissions, start, end)
    if sample is not None:
        rows = rows.where(sf.in_sample(F.col("k"), sample))
    return query_parsed(parse_whole(rows), terms, fields)


def query_parsed(documents: DataFrame, terms: Sequence[tuple] = (), fields: Sequence[str] = ()) -> DataFrame:
    """Predicates and projected fields of documents that are parsed, or stored, as ``doc``."""
    rows = where_all(documents, terms)
    return select_fields(rows, fields) if fields else rows.select("k", "json")


def shutdown_times(submissions: DataFrame, start: str, end: str, sample: float = 0.25) -> DataFrame:
    return adhoc_query(
        submissions, start, end, [("shutdownDuration", "values", "!=", "null")], sample,
        ["simpleMeasurements.shutdownDuration", "info.OS", "info.appVersion", "info.appBuildID"],
    )


# Statistics of extracts

def cycle_collector_averages(extract: DataFrame, **options) -> DataFrame:
    """Average pause per client and day, then mean and median of it per day and system."""
    typed = drop_incomplete(extract.select(
        "id", "os", sf.day_to_date(F.col("date_str")).alias("date"),
        *[sf.to_number(F.col(c)).alias(c) for c in ("hist_value", "hist_value_count", "hist_sum")],
    ))
    return statistics.two_level_average(
        typed, ["id", "date", "os"], ["date", "os"], "hist_value", "hist_value_count", **options
    )


def gc_ratio_stats(extract: DataFrame, **options) -> DataFrame:
    """Collections and collections per minute of uptime, by day and version.

    Only rows with a missing input, or with neither collections nor uptime, are left out; a row without
    uptime counts among the collections and has no ratio.
    """
    typed = drop_incomplete(extract.select("version", sf.day_to_date(F.col("date_str")).alias("date"), "sum_count", "uptime"))
    typed = typed.where((F.col("sum_count") != 0) | (F.col("uptime") != 0))
    typed = stage(typed.withColumn("ratio", sf.ratio(F.col("sum_count"), F.col("uptime"))), "ratios")
    keys = ["date", "version"]
    counts = group_statistics(typed, keys, "sum_count", MEDIAN, carry={"_sum": F.col("sum_count")}, **options).select(
        *keys, F.col("_sum").alias("sum_sum_count"), F.col("median").alias("median_sum_count"),
        F.col("mean").alias("avg_sum_count"), F.col("sd").alias("sd_sum_count"),
    )
    ratios = group_statistics(typed, keys, "ratio", MEDIAN, **options).select(
        *keys, F.col("median").alias("median_ratio"), F.col("mean").alias("avg_ratio"), F.col("sd").alias("sd_ratio")
    )
    return counts.join(ratios, keys)


def slow_sql_stats(extract: DataFrame, **options) -> DataFrame:
    """Per statement: runs, time, overall average, and mean, median and deviation of row averages."""
    typed = extract.select("sql", sf.to_number(F.col("count")).alias("count"), sf.to_number(F.col("time")).alias("time"))
    typed = typed.withColumn("avg_time", sf.ratio(F.col("time"), F.col("count")))
    stats = group_statistics(
        typed, ["sql"], "avg_time", MEDIAN, carry={"count": F.col("count"), "time": F.col("time")}, **options
    )
    return stats.select(
        "sql", "count", "time", sf.ratio(F.col("time"), F.col("count")).alias("avg_time"),
        F.col("mean").alias("avg_avg_time"), F.col("median").alias("median_avg_time"), F.col("sd").alias("sd_avg_time"),
    )


def slow_sql_by_time(extract: DataFrame) -> DataFrame:
    """Rows of the extract with their average, numbered from the longest total time down."""
    typed = extract.select("sql", sf.to_number(F.col("count")).alias("count"), sf.to_number(F.col("time")).alias("time"))
    rows = typed.select("*", sf.ratio(F.col("time"), F.col("count")).alias("avg_time"), (-F.col("time")).alias("_least"))
    return row_numbers(rows, ["_least", "sql", "count"]).drop("_least")


def slow_sql_by_count(extract: DataFrame, **options) -> DataFrame:
    """Statistics per statement, numbered from the most runs down."""
    stats = slow_sql_stats(extract, **options).withColumn("_least", -F.col("count"))
    return row_numbers(stats, ["_least", "sql"]).drop("_least")


def mean_ratio_by_sql(extract: DataFrame) -> DataFrame:
    rate = sf.ratio(F.col("time"), F.col("count"))
    return extract.groupBy("sql").agg(F.sum("count").alias("count"), F.avg(rate).alias("avg_time"))


def submission_trend(stats: DataFrame, product: str, versions: Sequence[str] | None = None) -> DataFrame:
    """Daily volume of one product in larger units, with the major version."""
    kept = stats.where(F.col("product") == product)
    if versions:
        kept = kept.where(F.col("version").isin(*versions))
    return kept.select(
        sf.day_to_date(F.col("date_str")).alias("date"), "version",
        sf.major_version(F.col("version")).alias("version_major"), "count",
        (F.col("avg_size") / 1024).alias("avg_size_kb"), (F.col("sum_size") / (1024 * 1024 * 1024)).alias("sum_size_gb"),
    )


def cohort_rows(extract: DataFrame, version: str, os: str, os_version: str) -> DataFrame:
    """First-paint rows of one release and system, split by interrupted start-up (0 or 1)."""
    return extract.where(
        (F.col("version") == version) & (F.col("os") == os) & (F.col("osversion") == os_version)
        & F.col("si").isin(0, 1) & (F.col("firstpaint") > 0)
    )


def cohort_summary(extract: DataFrame, version: str, os: str, os_version: str, value: str = "firstpaint",
                   **options) -> DataFrame:
    return statistics.six_numbers(cohort_rows(extract, version, os, os_version), ["si"], value, **options)


def cohort_bins(extract: DataFrame, version: str, os: str, os_version: str, value: str = "firstpaint") -> DataFrame:
    """Distribution of the clamped value per cohort in bins of 1000 up to 30000."""
    rows = cohort_rows(extract, version, os, os_version)
    clamped = rows.withColumn(value, sf.clamp_low_high(F.col(value), 30000, 31000))
    return statistics.bins(clamped, ["si"], value, 0, 30000, 1000)


def late_paint_bins(extract: DataFrame, version: str, os: str, value: str = "firstpaint") -> DataFrame:
    """Density of late values of one release and system in bins of 5000 from 60000 to 600000."""
    rows = extract.where((F.col("version") == version) & (F.col("os") == os) & F.col(value).isNotNull() & F.col("ndco").isNotNull())
    return statistics.bins(rows.withColumn(value, sf.cap(F.col(value), 600000, 605000)), [], value, 60000, 600000, 5000)


def cohort_distribution(extract: DataFrame, version: str, os: str, os_version: str, si: int,
                        value: str = "firstpaint", **options) -> DataFrame:
    rows = cohort_rows(extract, version, os, os_version).where(F.col("si") == si)
    return distribution(rows.withColumn(value, sf.clamp_low_high(F.col(value), 30000, 31000)), value, **options)


