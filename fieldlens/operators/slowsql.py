"""Slow SQL statements: rows, masking of private literals, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.documents import as_map, bind, number, once, parse, top_level
from fieldlens.functions.scalars import mask_literals, normalize_sql, ratio
from fieldlens.operators.ranking import counted_statistics, exact_sum, value_counts
from fieldlens.operators.selection import selected_quantiles
from fieldlens.schema import SLOW_SQL_QUANTILES
from fieldlens.session import stage

THREADS = ("mainThread", "otherThreads")
REPORT_KEYS = ["thread", "d", "product", "product_version", "product_channel", "sql"]


def _numbers(value: Column) -> Column:
    """Numeric elements of a statement's ``[count, time]`` array; other elements are left out."""
    array = F.try_variant_get(value, F.lit("$"), "array<variant>")
    return F.filter(F.transform(array, lambda x: number(x, "bigint")), lambda x: x.isNotNull())


def _added(numbers: Column) -> Column:
    """Sum of an array's numbers as a decimal, which 64 bits do not bound; NULL counts as 0."""
    zero = F.lit(0).cast("decimal(38,0)")
    return F.aggregate(numbers, zero, lambda a, b: (a + F.coalesce(b.cast("decimal(19,0)"), F.lit(0))).cast("decimal(38,0)"))


def _scrubbed_entries(compat: bool) -> Column:
    """Masked texts of the other threads' statements with their numbers; those that become equal are added up."""
    masked = F.transform(
        F.map_entries(F.col("slowSQL")["otherThreads"]),
        lambda e: F.struct(mask_literals(e["key"], compat).alias("key"), _numbers(e["value"]).alias("pair")),
    )

    def merged(entries):
        def of_text(text):
            group = F.filter(entries, lambda e: e["key"] == text)
            pair = F.when(F.size(group) == 1, F.get(group, F.lit(0))["pair"]).otherwise(
                F.array(*[_added(F.transform(group, lambda e: F.get(e["pair"], F.lit(place)))).try_cast("bigint") for place in (0, 1)]))
            return F.struct(text.alias("key"), pair.alias("pair"))

        texts = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.when(F.size(texts) == F.size(entries), entries).otherwise(F.transform(texts, of_text))

    return bind(masked, merged)


def statements(df: DataFrame, carry: Sequence[str | Column], threads: Sequence[str] = THREADS, scrub: bool = False, compat: bool = False) -> DataFrame:
    """One row per recorded statement with normalized text, run count and total time.

    With ``scrub`` the other threads' statements are masked first, as :func:`with_scrubbed` would, without the
    document being written and read again.
    """
    empty = F.array().cast("array<struct<thread:string,sql:string,pair:array<bigint>>>")

    def of_thread(thread):
        if scrub and thread == "otherThreads":
            entries = _scrubbed_entries(compat)
        else:
            entries = F.transform(F.map_entries(F.col("slowSQL")[thread]), lambda e: F.struct(e["key"].alias("key"), _numbers(e["value"]).alias("pair")))
        rows = F.transform(entries, lambda e: F.struct(F.lit(thread).alias("thread"), normalize_sql(e["key"]).alias("sql"), e["pair"].alias("pair")))
        return F.coalesce(rows, empty)

    found = F.filter(F.concat(*[of_thread(t) for t in threads]), lambda e: e["pair"].isNotNull())
    prepared = once(df, *carry, found.alias("_found"))
    out = prepared.select(*[c for c in prepared.columns if c != "_found"], F.inline("_found"))
    return out.select(
        *[c for c in out.columns if c != "pair"],
        F.get("pair", F.lit(0)).alias("count"), F.get("pair", F.lit(1)).alias("t"),
    )


def with_average(rows: DataFrame) -> DataFrame:
    return rows.withColumn("avg_time", ratio(F.col("t"), F.col("count")))


def quantile_report(rows: DataFrame, keys: Sequence[str] = REPORT_KEYS,
                    quantiles: Mapping[str, tuple[int, int]] = SLOW_SQL_QUANTILES, min_docs: int = 0, **options) -> DataFrame:
    """Rows, summed run count and exact quantiles of the average time per statement.

    Most statements are rare: groups of up to ``min_docs`` rows go before anything is ranked. While values
    are ranked a digest stands for the statement, and the text comes back at the end.
    """
    counts = stage(value_counts(with_average(rows), keys, "avg_time", {"sum_count": F.col("count")}), "counts")
    if min_docs:
        frequent = counts.groupBy(*keys).agg(F.sum("doc_count").alias("_docs")).where(F.col("_docs") > min_docs)
        frequent = frequent.select(F.struct(*keys).alias("_group"))
        counts = counts.withColumn("_group", F.struct(*keys)).join(frequent, "_group", "left_semi").drop("_group")
    digested = counts.withColumn("_text", F.col("sql")).withColumn("sql", F.md5("sql"))
    stats = counted_statistics(
        digested.drop("_text"), keys, "avg_time", "n", quantiles, "average", ["doc_count", "sum_count"], **options
    )
    texts = digested.where(F.col("sql").isNotNull()).select("sql", "_text").distinct()
    named = stats.join(texts, "sql", "left").withColumn("sql", F.col("_text"))
    return named.select(*keys, "doc_count", "sum_count", *quantiles)


def selected_report(rows: DataFrame, keys: Sequence[str] = REPORT_KEYS, quantiles: Mapping[str, tuple[int, int]] = SLOW_SQL_QUANTILES) -> DataFrame:
    """As :func:`quantile_report` by selection: counting passes instead of sorted ranges, for groups of many rows.

    Only counts are shuffled. A digest stands for the statement; its text comes back at the end. The rows are
    written once, as both need them. A run count beyond 64 bits is NULL.
    """
    named = with_average(rows).select(*keys, "count", "avg_time")
    narrow = stage(named.withColumn("_text", F.col("sql")).withColumn("sql", F.md5("sql")), "statements")
    stats = selected_quantiles(narrow, keys, "avg_time", quantiles, "average", {"sum_count": F.col("count")})
    texts = narrow.where(F.col("sql").isNotNull()).groupBy("sql").agg(F.first("_text").alias("_text"))
    named = stats.join(texts, "sql", "left").withColumn("sql", F.col("_text"))
    return named.select(*keys, "doc_count", F.col("sum_count").try_cast("bigint").alias("sum_count"), *quantiles)


def approximate_report(rows: DataFrame, keys: Sequence[str] = REPORT_KEYS, accuracy: int = 10_000) -> DataFrame:
    """As :func:`quantile_report` with mergeable sketches: one shuffle of partial aggregates."""
    names = list(SLOW_SQL_QUANTILES)
    shares = [num / den for num, den in SLOW_SQL_QUANTILES.values()]
    grouped = with_average(rows).groupBy(*keys).agg(
        F.count("*").alias("doc_count"), exact_sum(rows, F.col("count")).try_cast("bigint").alias("sum_count"),
        F.percentile_approx("avg_time", shares, accuracy).alias("_q"),
    )
    return grouped.select(
        *keys, "doc_count", "sum_count", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(names)]
    )


def with_scrubbed(df: DataFrame, compat: bool = False, json: str = "json", out: str = "new_json") -> DataFrame:
    """Add the document with masked literals in the statements of other threads, NULL when unchanged.

    Works inside each document, so nothing is shuffled. Statements that become equal are merged by
    adding up counts and times, exactly: a sum may have more than 64 bits.
    """
    def masked(text):
        return mask_literals(text, compat)

    statements_map = F.col("slowSQL")["otherThreads"]
    pairs = F.transform(
        F.map_entries(statements_map),
        lambda e: F.struct(masked(e["key"]).alias("key"), e["key"].alias("old"), e["value"].alias("value")),
    )
    parsed = parse(df, "slowSQL", json=json)
    prepared = once(parsed, *df.columns, pairs.alias("_pairs"))
    changed = F.coalesce(F.exists("_pairs", lambda p: p["key"] != p["old"]), F.lit(False))
    texts = F.array_distinct(F.transform("_pairs", lambda p: p["key"]))

    def total(numbers, place):
        return _added(F.transform(numbers, lambda n: F.get(n, F.lit(place))))

    def merged(text):
        def of_group(group):
            summed = bind(F.transform(group, lambda p: _numbers(p["value"])), lambda found: F.array(total(found, 0), total(found, 1)))
            value = F.when(F.size(group) == 1, F.get(group, F.lit(0))["value"]).otherwise(F.to_variant_object(summed))
            return F.struct(text.alias("key"), value.alias("value"))

        return bind(F.filter("_pairs", lambda p: p["key"] == text), of_group)

    # Merging looks at the other statements of the document, so it is done only where texts collide.
    plain = F.transform("_pairs", lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))
    entries = F.when(F.size(texts) == F.size("_pairs"), plain).otherwise(F.transform(texts, merged))
    new_slow = F.map_concat(
        F.map_filter(as_map(F.col("_top")["slowSQL"]), lambda name, _: name != "otherThreads"),
        F.create_map(F.lit("otherThreads"), F.to_variant_object(F.map_from_entries(entries))),
    )
    new_top = F.map_concat(
        F.map_filter("_top", lambda name, _: name != "slowSQL"),
        F.create_map(F.lit("slowSQL"), F.to_variant_object(new_slow)),
    )
    # The whole document is read again only where it changes.
    ready = once(prepared, *df.columns, "_pairs", F.when(changed, top_level(json)).alias("_top"))
    return once(ready, *df.columns, F.when(F.col("_top").isNotNull(), F.to_json(new_top)).alias(out))


def scrub(df: DataFrame, compat: bool = False) -> DataFrame:
    """Key and new JSON of the submissions that masking changes."""
    rewritten = with_scrubbed(df, compat).where(F.col("new_json").isNotNull())
    return rewritten.select("k", F.col("new_json").alias("json"))
