"""One query per operator and job, over submissions derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.functions import documents as docs
from fieldlens.functions import predicates as pred
from fieldlens.functions import scalars as sf
from fieldlens.functions import sql as sql_functions
from fieldlens.operators import hangs, histograms, ranking, sketches, slowsql, statistics, validation
from fieldlens.plans import jobs, kept, tables
from fieldlens.schema import CYCLE_COLLECTOR_DDL, DEFAULT_REASONS, FINGERPRINT_FIELDS, GC_UPTIME_DDL, SLOW_SQL_DDL, SUBMISSION_STATS_DDL
from fieldlens.session import configure, fresh_path, stage
from fieldlens.sources import catalog, delimited
from fieldlens.sources import submissions as store
from fieldlens.testbed import data
from fieldlens.testbed.data import ALL_PRODUCTS, DESKTOP, MOBILE, TOUCH, submissions

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

START, END = "20240105", "20240112"
AS_OF = "2024-01-31"
MIN_DOCS = 5


def query(function: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return function(spark, sf_dir)

    REGISTRY[function.__name__] = configured
    return function


def _from_file(extract: DataFrame, schema: str) -> DataFrame:
    """The extract as analyses get it: a tab-separated file read with names and types."""
    path = fresh_path(extract.sparkSession, "extract")
    store.write_delimited(extract, path, sep="\t")
    return store.read_delimited(extract.sparkSession, path, schema, "\t")


def _six(value):
    """Six digits; the small shift keeps values off the rounding border, as in the SQL."""
    return F.round((F.col(value) if isinstance(value, str) else value) + 1e-9, 6)


# Sources and sinks

@query
def scan_date_range(spark, sf_dir):
    return store.in_date_range(submissions(spark, sf_dir), START, END).select("k", "d", "json")


@query
def row_key_decode(spark, sf_dir):
    return store.decode_keys(submissions(spark, sf_dir))


@query
def archive_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "archive")
    store.write_archive(submissions(spark, sf_dir), path)
    return store.read_archive(spark, path)


@query
def store_roundtrip(spark, sf_dir):
    """Write by day, write two days again, and scan a range from the store."""
    path = fresh_path(spark, "store")
    rows = submissions(spark, sf_dir)
    store.write_store(rows, path)
    store.write_store(store.in_date_range(rows, END, END), path)
    stored = store.in_date_range(store.read_store(spark, path), START, END)
    return stored.groupBy("d").agg(F.count("*").alias("n"), F.sum(F.length("json")).alias("chars"))


@query
def upsert_overlay(spark, sf_dir):
    """Updates replace a third of the stored rows and add new ones, in place in the store."""
    rows, path = submissions(spark, sf_dir), fresh_path(spark, "store")
    marker = F.conv(F.substring("k", 10, 2), 16, 10).cast("int")
    base = rows.where(marker % 5 != 0)
    updates = rows.where(marker % 3 == 0).select("k", F.concat(F.lit("new:"), F.substring("k", 2, 8)).alias("json"))
    store.write_store(base, path)
    store.upsert(spark, path, updates)
    return store.read_store(spark, path).select("k", "d", F.md5("json").alias("digest"))


@query
def import_archive(spark, sf_dir):
    """A store that holds half of the keys with other documents takes in the whole archive."""
    rows, archive, path = submissions(spark, sf_dir), fresh_path(spark, "archive"), fresh_path(spark, "store")
    store.write_archive(rows, archive)
    older = rows.where(F.conv(F.substring("k", 10, 2), 16, 10).cast("int") % 2 == 0)
    store.write_store(older.withColumn("json", F.lit("old")), path)
    store.import_archive(spark, archive, path)
    return store.read_store(spark, path).select("k", "d", F.md5("json").alias("digest"))


def _sunk(spark, sf_dir):
    """Comma, control-A and tab files, and one compressed file with a header, read back: rows and exact digest by sink and day."""
    rows = store.decode_keys(submissions(spark, sf_dir)).select("k", "d", "uuid")
    found = None
    for name, options in {
        "comma": {"sep": ","},
        "control-a": {"sep": "\x01"},
        "tab": {"sep": "\t", "compression": "gzip"},
        "single": {"sep": "\t", "header": True, "single_file": True},
    }.items():
        path = fresh_path(spark, f"delimited-{name}")
        part = rows if name != "single" else rows.groupBy("d").agg(F.count("*").cast("string").alias("k")).select("k", "d", F.col("d").alias("uuid"))
        store.write_delimited(part, path, **options)
        back = store.read_delimited(
            spark, path, "k string, d string, uuid string", options["sep"], options.get("header", False)
        ).select(F.lit(name).alias("sink"), "k", "d", "uuid")
        found = back if found is None else found.unionByName(back)
    found = found.withColumn("digest", F.conv(F.substring(F.md5(F.concat_ws("|", "k", "d", "uuid")), 1, 12), 16, 10).cast("bigint"))
    return found.groupBy("sink", "d").agg(F.count("*").alias("n"), ranking.exact_sum(found, F.col("digest")).alias("digest"))


@query
def delimited_sink(spark, sf_dir):
    """All sinks read back; a digest that does not fit 64 bits is NULL, see :func:`delimited_sink_digests`."""
    return _sunk(spark, sf_dir).withColumn("digest", F.col("digest").try_cast("bigint"))


@query
def delimited_sink_digests(spark, sf_dir):
    """The same with every digest whole, as text."""
    return _sunk(spark, sf_dir).withColumn("digest", F.col("digest").cast("string"))


@query
def delimited_source(spark, sf_dir):
    """Tab-separated extract read with names and types; text that is not a number is NULL."""
    raw = _from_file(data.cycle_collector_extract(spark, sf_dir), CYCLE_COLLECTOR_DDL)
    return raw.select(
        "id", "date_str", "os", sf.to_number(F.col("hist_value")).alias("hist_value"),
        sf.to_number(F.col("hist_value_count")).alias("hist_value_count"),
    )


def _damaged_lines(spark, sf_dir, path):
    """The extract of the collector as lines, of which some lack a field, have one too many, or a text for a number."""
    fields = [F.col("id"), F.col("date_str"), F.col("os"), F.col("hist_value"), F.col("hist_value_count")]
    rows, n = data.cycle_collector_extract(spark, sf_dir), F.col("hist_sum").cast("bigint")
    line = F.when(n % 11 == 3, F.concat_ws("\t", *fields[:4])).when(n % 11 == 7, F.concat_ws("\t", *fields, F.lit("more"))).when(n % 11 == 9, F.lit("")).otherwise(
        F.concat_ws("\t", *fields))
    rows.select(line.alias("value")).write.text(path)
    return "id string, date_str string, os string, hist_value double, hist_value_count bigint"


@query
def checked_lines(spark, sf_dir):
    """Accepted rows of a damaged extract; rejected lines are kept apart."""
    path, rejects = fresh_path(spark, "lines"), fresh_path(spark, "rejects")
    schema = _damaged_lines(spark, sf_dir, path)
    return delimited.split_rejected(spark, path, schema, rejects)


@query
def rejected_lines(spark, sf_dir):
    """Lines by the reason for which they were rejected, from where they are kept."""
    path, rejects = fresh_path(spark, "lines"), fresh_path(spark, "rejects")
    schema = _damaged_lines(spark, sf_dir, path)
    delimited.split_rejected(spark, path, schema, rejects)
    return spark.read.parquet(rejects).groupBy("reason", "line").agg(F.count("*").alias("n"))


@query
def single_report_file(spark, sf_dir):
    """The submission volume in one headered file, written by several tasks, read back by its name."""
    stats = jobs.submission_stats(submissions(spark, sf_dir), by_product=True)
    ordered = stats.select("d", "product", "product_version", "count", "sum_size").repartitionByRange(4, "d", "product", "product_version")
    path = f"{fresh_path(spark, 'report')}/volume.tsv.gz"
    delimited.write_single_file(ordered, path, sep="\t", header=True, compression="gzip")
    return store.read_delimited(spark, path, "d string, product string, product_version string, count bigint, sum_size bigint", header=True)


@query
def key_json_lines(spark, sf_dir):
    path = fresh_path(spark, "lines")
    store.write_key_json_lines(submissions(spark, sf_dir).where("json is not null"), path)
    rows = store.read_key_json_lines(spark, path)
    return rows.select("k", F.length("json").alias("chars"), F.md5("json").alias("digest"))


@query
def ping_payload_extract(spark, sf_dir):
    """Saved pings hold the document as escaped text under ``payload``."""
    pings = submissions(spark, sf_dir).where("json is not null").select(
        F.to_json(F.struct(F.col("k").alias("slug"), F.col("json").alias("payload"))).alias("value")
    )
    payloads = store.ping_payloads(pings)
    return payloads.select("k", F.md5("json").alias("digest"))


@query
def retention_filter(spark, sf_dir):
    months = data.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("agg_valid_"), F.date_format("o_orderdate", "yyyyMM")).alias("name")
    ).distinct()
    return catalog.retention(months, "1997-01-15")


@query
def completeness_audit(spark, sf_dir):
    """Per day and dataset counts of what the day's events yield; gaps and empty days are reported."""
    facts = data.facts(spark, sf_dir)
    dataset = F.element_at(F.array(*[F.lit(x) for x in data.DATASETS]), (F.col("u") % 5 + 1).cast("int"))
    day_ok = F.col("d").substr(7, 2).cast("int") % 7 != F.col("u") % 5
    found = facts.where(day_ok).groupBy(dataset.alias("dataset"), "d").agg(
        F.count_if(F.col("kind") != "click").alias("n")
    )
    return catalog.audit(found, data.DATASETS, AS_OF, 30)


@query
def storage_audit(spark, sf_dir):
    """The same report from a store on disk: days are written by dataset, those without other rows as empty files."""
    facts, root = data.facts(spark, sf_dir), fresh_path(spark, "datasets")
    named = facts.withColumn("dataset", F.element_at(F.array(*[F.lit(x) for x in data.DATASETS]), (F.col("u") % 5 + 1).cast("int")))
    kept = stage(named.where(F.col("d").substr(7, 2).cast("int") % 7 != F.col("u") % 5).select("dataset", "d", "e", "kind"), "facts")
    for dataset in data.DATASETS[:5]:
        own = kept.where(F.col("dataset") == dataset)
        own.where("kind <> 'click'").select("e", "d").write.partitionBy("d").parquet(f"{root}/{dataset}")
        full = {r[0] for r in own.where("kind <> 'click'").select("d").distinct().collect()}
        for day in sorted({r[0] for r in own.select("d").distinct().collect()} - full):  # a month of days
            own.limit(0).select("e").coalesce(1).write.parquet(f"{root}/{dataset}/d={day}")
    return catalog.audit_storage(spark, root, data.DATASETS, AS_OF, 30)


@query
def retention_on_storage(spark, sf_dir):
    """Months of orders as directories: a dry run, a real one, and what is left with its rows."""
    root = fresh_path(spark, "months")
    orders = data.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("valid_"), F.date_format("o_orderdate", "yyyyMM")).alias("agg"))
    orders.hint("rebalance", "agg").write.partitionBy("agg").parquet(root)
    dry = catalog.apply_retention(spark, root, "1997-01-15").select("name", "age_days", "expired", F.col("deleted").alias("deleted_dry"))
    done = catalog.apply_retention(spark, root, "1997-01-15", dry_run=False).select("name", "deleted")
    left = spark.read.parquet(root).groupBy(F.concat(F.lit("agg="), "agg").alias("name")).agg(F.count("*").alias("n"))
    return dry.join(done, "name").join(left, "name", "left")


# Nested access and projection

@query
def json_parse(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    return whole.select("k", F.col("doc").isNotNull().alias("parsed"), docs.get("ver", "int").alias("ver"))


@query
def json_nested_get(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    return whole.select(
        "k", docs.get("info.appName").alias("product"), docs.get("info.cpucount", "int").alias("cpucount"),
        docs.get("simpleMeasurements.js.e4x", "int").alias("e4x"),
        docs.get(["histograms", "PAUSE_MS", "bucket_count"], "int").alias("bucket_count"),
        docs.get("info.missing.deeper").alias("missing"),
    )


@query
def project_dims(spark, sf_dir):
    return docs.parse(submissions(spark, sf_dir), "info").select("k", *docs.dimension_columns())


@query
def select_fields(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    return docs.select_fields(whole, ["info.OS", "simpleMeasurements.firstPaint", "info.locale", "ver"])


@query
def single_histogram(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    return docs.select_fields(whole, ["info.appVersion", "histograms.PAUSE_MS"])


def _stored_variants(spark, sf_dir):
    path = fresh_path(spark, "variants")
    tables.write_variants(submissions(spark, sf_dir), path)
    return tables.read_variants(spark, path)


@query
def variant_select_fields(spark, sf_dir):
    """Fields of stored, shredded documents."""
    return docs.select_fields(_stored_variants(spark, sf_dir), ["info.OS", "simpleMeasurements.firstPaint", "info.locale", "ver"])


@query
def variant_single_histogram(spark, sf_dir):
    return docs.select_fields(_stored_variants(spark, sf_dir), ["info.appVersion", "histograms.PAUSE_MS"])


@query
def variant_adhoc_query(spark, sf_dir):
    """The ad-hoc query on stored documents of its days."""
    rows = store.in_date_range(_stored_variants(spark, sf_dir), START, END).where(sf.in_sample(F.col("k"), 0.5))
    return jobs.query_parsed(rows, [("firstPaint", None, ">", 1000), ("appVersion", None, "!=", "null")],
                             ["info.appName", "simpleMeasurements.firstPaint", "histograms.CYCLE_MS"])


@query
def flag_projection(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info", histograms="struct<OUT_OF_MEMORY_KILLED: variant>")
    return rows.select(
        "k", sf.flag(docs.info("hasARMv6") == "true").alias("has_armv6"),
        sf.flag(docs.info("hasARMv7") == "true").alias("has_armv7"),
        sf.flag(docs.is_present(F.col("histograms")["OUT_OF_MEMORY_KILLED"])).alias("has_oom_killed"),
        sf.null_default(docs.info("flashVersion")).alias("flash_version"),
    )


@query
def sample_hash(spark, sf_dir):
    return submissions(spark, sf_dir).where(sf.in_sample(F.col("k"), 0.25)).select("k")


@query
def export_split(spark, sf_dir):
    """Both outputs from one read, written by bucket and read back."""
    path = fresh_path(spark, "export")
    store.export_buckets(submissions(spark, sf_dir), 0.1).write.partitionBy("bucket").parquet(path)
    return spark.read.parquet(path).select("k", F.md5("json").alias("digest"), F.col("bucket").cast("string").alias("bucket"))


@query
def export_union(spark, sf_dir):
    return store.export_union(store.export_buckets(submissions(spark, sf_dir), 0.1)).groupBy(sf.day_from_key(F.col("k")).alias("d")).agg(F.count("*").alias("n"))


# Filters

@query
def filter_product_reason(spark, sf_dir):
    return jobs.complete_submissions(submissions(spark, sf_dir), ALL_PRODUCTS, **docs.PRESENCE).select("k")


@query
def filter_not_null(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info", "slowSQL")
    return rows.where(docs.info("appVersion").isNotNull() & F.col("slowSQL")["mainThread"].isNotNull()).select("k")


@query
def filter_is_map(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    parts = ["info", "histograms", "simpleMeasurements", "chromeHangs"]
    return whole.select("k", *[docs.is_map(p).alias(f"{p}_is_map") for p in parts])


@query
def hang_filter(spark, sf_dir):
    return jobs.hang_submissions(submissions(spark, sf_dir))


@query
def count_valid_invalid(spark, sf_dir):
    validated = jobs.validate_submissions(submissions(spark, sf_dir), data.specification(spark))
    return jobs.count_valid_invalid(validated)


@query
def having_threshold(spark, sf_dir):
    rows = jobs.slow_sql_rows(submissions(spark, sf_dir))
    return rows.groupBy("thread", "sql").agg(F.count("*").alias("doc_count")).where(F.col("doc_count") > 100)


@query
def filter_in_list(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info")
    return rows.where(docs.info("appVersion").isin("18.0.1", "9.0", "7.0")).select("k", docs.info("appVersion").alias("product_version"))


@query
def drop_incomplete(spark, sf_dir):
    rows = data.first_paint_extract(spark, sf_dir)
    return pred.drop_incomplete(rows.select("version", "firstpaint", "sessionrestored", "places"))


@query
def value_compare(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    cases = {
        "bucket_over_50": pred.compares("CYCLE_MS", ">", 5),
        "bucket_equal_90": pred.compares("PAUSE_MS", "=", 90, "values"),
        "sum_at_most_20": pred.compares("PAUSE_MS", "<=", 20, "sum"),
        "paint_at_least_9000": pred.compares("firstPaint", ">=", 9000),
        "shutdown_present": pred.compares("shutdownDuration", "!=", "null"),
        "sum_is_null": pred.compares("PAUSE_MS", "=", "null", "sum"),
        "os_is_linux": pred.compares("OS", "=", "Linux"),
        "os_not_linux": pred.compares("OS", "!=", "Linux"),
        "armv6_true": pred.compares("hasARMv6", "=", True),
        "cpus_under_3": pred.compares("cpucount", "<", 3),
        "unknown_key": pred.compares("NO_SUCH_KEY", "=", 1),
    }
    return whole.select("k", *[condition.alias(name) for name, condition in cases.items()])


@query
def conjunctive_filter(spark, sf_dir):
    whole = docs.parse_whole(submissions(spark, sf_dir))
    terms = [("firstPaint", None, ">", 2000), ("OS", None, "=", "WINNT"), ("USED_FLAG", "sum", "=", 1)]
    return pred.where_all(whole, terms).select("k")


# Row generators

def _dims_parsed(spark, sf_dir):
    return jobs.complete_submissions(submissions(spark, sf_dir), ALL_PRODUCTS)


@query
def hist_by_name_rows(spark, sf_dir):
    return histograms.by_name(_dims_parsed(spark, sf_dir), ["k"])


@query
def hist_by_value_rows(spark, sf_dir):
    return histograms.by_value(histograms.entries(_dims_parsed(spark, sf_dir), ["k"]))


@query
def simple_measure_rows(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "simpleMeasurements")
    return histograms.by_value(histograms.entries(rows, ["k"], histograms=False))


@query
def histogram_names(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "histograms", "simpleMeasurements")
    return histograms.names(rows, ["k"]).groupBy("hist_name").agg(F.count("*").alias("n"))


@query
def slowsql_rows(spark, sf_dir):
    return slowsql.statements(docs.parse(submissions(spark, sf_dir), "slowSQL"), ["k"])


@query
def slowsql_rows_sql(spark, sf_dir):
    """The statement rows in SQL alone."""
    sql_functions.register(spark)
    return spark.sql("""
        SELECT k, e.* FROM (SELECT k, slow_sql_entries(json) AS entries FROM {submissions})
        LATERAL VIEW OUTER inline(entries) e WHERE e.thread IS NOT NULL""", submissions=submissions(spark, sf_dir))


@query
def os_version_sql(spark, sf_dir):
    """Systems and kernels counted in SQL alone."""
    sql_functions.register(spark)
    return spark.sql("""
        SELECT version, os_version(version) AS os_version, kernel_version(version) AS normalized_kernel_version, n
        FROM (SELECT version, count(*) AS n FROM (SELECT try_variant_get(try_parse_json(json), '$.info.version', 'string') AS version FROM {submissions})
              GROUP BY version)""", submissions=submissions(spark, sf_dir))


@query
def buckets_sql(spark, sf_dir):
    """The buckets of generic measures in SQL alone."""
    sql_functions.register(spark)
    return spark.sql("""
        SELECT e, grid_bucket(t, 0, 30001, 1000) AS other, grid_bucket(t, 30000, 90000, 2000) AS crash, grid_bucket(n, 0, 50, 1) AS pings
        FROM (SELECT e, n, CAST(floor(x * 300) AS BIGINT) - 500 AS t FROM {facts})""", facts=data.facts(spark, sf_dir))


@query
def flatten_rows(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "histograms")
    return rows.select("k", F.explode("histograms").alias("hist_name", "h")).select(
        "k", "hist_name", F.explode(docs.get("range", "array<int>", "h")).alias("edge")
    ).groupBy("hist_name", "edge").agg(F.count("*").alias("n"))


# Scalar functions

@query
def null_default(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info")
    return rows.select("k", sf.null_default(docs.info("appUpdateChannel")).alias("product_channel"))


@query
def os_version_normalize(spark, sf_dir):
    version = docs.info("version")
    rows = docs.parse(submissions(spark, sf_dir), "info").select(
        version.alias("version"), sf.os_version(version).alias("os_version"),
        sf.kernel_version(version).alias("normalized_kernel_version"),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query
def kernel_to_android(spark, sf_dir):
    version = docs.info("version")
    return docs.parse(submissions(spark, sf_dir), "info").select(
        "k", version.alias("kernel_version"), sf.kernel_release(version).alias("os_version")
    )


@query
def submission_stats(spark, sf_dir):
    stats = jobs.submission_stats(submissions(spark, sf_dir))
    return stats.withColumn("avg_size", _six("avg_size"))


@query
def submission_stats_by_product(spark, sf_dir):
    stats = jobs.submission_stats(submissions(spark, sf_dir), by_product=True)
    return stats.select("d", "product", "product_version", "count", "sum_size", _six("avg_size").alias("avg_size"))


@query
def bucket_uptime(spark, sf_dir):
    minutes = F.floor(F.col("x") * 10).cast("bigint") - F.when(F.col("e") % 11 == 0, 50).otherwise(0)
    return data.facts(spark, sf_dir).select("e", minutes.alias("minutes"), sf.uptime_bucket(minutes).alias("bucket"))


@query
def bucket_generic(spark, sf_dir):
    t = F.floor(F.col("x") * 300).cast("bigint") - 500
    return data.facts(spark, sf_dir).select(
        "e", sf.grid_bucket(t, 0, 30001, 1000).alias("other"), sf.grid_bucket(t, 30000, 90000, 2000).alias("crash"),
        sf.grid_bucket(F.col("n"), 0, 50, 1).alias("pings"),
    )


@query
def avg_time_ratio(spark, sf_dir):
    rows = slowsql.statements(docs.parse(submissions(spark, sf_dir), "slowSQL"), ["k"])
    return slowsql.with_average(rows).select("k", "thread", "count", "t", _six("avg_time").alias("avg_time"))


@query
def mask_sql_literals(spark, sf_dir):
    """Texts with quotes: the documents table, whole, with both masks."""
    rows = data.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("INSERT '"), F.col("lang"), F.lit("\\'s' x \""), F.col("source"), F.lit("\" "), "text").alias("sql")
    )
    return rows.select(
        "doc_id", F.md5(sf.mask_literals(F.col("sql"))).alias("masked"),
        F.md5(sf.mask_literals(F.col("sql"), compat=True)).alias("masked_compat"),
    )


@query
def config_fingerprint(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info").where(docs.is_object(F.col("info")))
    fields = docs.once(rows, docs.info_fields(FINGERPRINT_FIELDS).alias("_info"))
    return fields.groupBy(sf.fingerprint(lambda name: F.col("_info")[name]).alias("fingerprint")).agg(F.count("*").alias("n"))


@query
def date_parse(spark, sf_dir):
    return submissions(spark, sf_dir).select("k", sf.day_to_date(F.col("d")).alias("date"))


@query
def major_version(spark, sf_dir):
    version = docs.info("appVersion")
    rows = docs.parse(submissions(spark, sf_dir), "info")
    return rows.groupBy(version.alias("version"), sf.major_version(version).alias("version_major")).agg(F.count("*").alias("n"))


@query
def clamp_recode(spark, sf_dir):
    rows = data.first_paint_extract(spark, sf_dir).select(
        sf.clamp_low_high(F.col("firstpaint"), 30000, 31000).cast("bigint").alias("firstpaint"),
        sf.cap(F.col("ndco"), 30000, 31000).cast("bigint").alias("ndco"),
    )
    return rows.groupBy("firstpaint", "ndco").agg(F.count("*").alias("n"))


@query
def minmax_scale(spark, sf_dir):
    rows = data.first_paint_extract(spark, sf_dir).where("firstpaint is not null").select("firstpaint", "ndco")
    scaled = statistics.min_max_scaled(rows, "firstpaint", "scaled")
    return scaled.groupBy("firstpaint", _six("scaled").alias("scaled")).agg(F.count("*").alias("n"))


# Aggregates of histograms

@query
def count_by_version(spark, sf_dir):
    return jobs.count_by_version(submissions(spark, sf_dir), [DESKTOP])


@query
def expansion_warnings(spark, sf_dir):
    return histograms.warnings(_dims_parsed(spark, sf_dir), docs.dimension_columns())


@query
def hist_name_totals(spark, sf_dir):
    return histograms.name_totals(jobs.histogram_rows(submissions(spark, sf_dir), ALL_PRODUCTS))


@query
def hist_value_totals(spark, sf_dir):
    rows = histograms.by_value(jobs.histogram_rows(submissions(spark, sf_dir), ALL_PRODUCTS))
    return histograms.value_totals(rows)


@query
def hist_join_name_value(spark, sf_dir):
    """The join of both totals. The rows are staged, so that they are made once for both sides."""
    rows = stage(jobs.histogram_rows(submissions(spark, sf_dir), ALL_PRODUCTS), "entries")
    return histograms.join_name_value(
        histograms.name_totals(rows.drop("buckets")), histograms.value_totals(histograms.by_value(rows))
    )


@query
def daily_aggregates(spark, sf_dir):
    return jobs.daily_aggregates(submissions(spark, sf_dir), ALL_PRODUCTS)


@query
def aggregate_json_docs(spark, sf_dir):
    """Aggregate documents written day after day, one day twice, and summarized from their JSON."""
    made = stage(jobs.aggregate_documents(submissions(spark, sf_dir), ALL_PRODUCTS), "documents")
    path = fresh_path(spark, "aggregates")
    for days in (F.col("d") <= START, F.col("d") >= START):
        store.write_documents(made.where(days), path)
    return _summary(store.read_documents(spark, path).select("month", "value"))


@query
def validated_aggregates(spark, sf_dir):
    """Documents validated against the specification first, then aggregated."""
    made = jobs.validated_aggregates(submissions(spark, sf_dir), data.specification(spark), ALL_PRODUCTS)
    return _summary(made.select("month", F.col("agg_json").alias("value")))


def _summary(documents):
    histogram = (
        "struct<values: array<array<bigint>>, count: bigint, sum: bigint, bucket_count: int, "
        "`range`: array<bigint>, histogram_type: int>"
    )
    schema = (
        "date string, info struct<reason: string, appName: string, appVersion: string, appUpdateChannel: string, "
        "arch: string, OS: string, version: string, appBuildID: string, platformBuildID: string, valid: boolean>, "
        f"histogram_names array<string>, histograms map<string, {histogram}>"
    )
    back = documents.select("month", F.from_json("value", schema).alias("j")).select("month", "j.*")
    per_hist = back.select("*", F.explode("histograms").alias("hist_name", "h"))
    weighted = F.aggregate("h.values", F.lit(0).cast("bigint"), lambda a, p: a + F.get(p, F.lit(0)) * F.get(p, F.lit(1)))
    return per_hist.select(
        "month", "date", *[F.col(f"info.{c}").alias(c) for c in (
            "reason", "appName", "appVersion", "appUpdateChannel", "arch", "OS", "version", "appBuildID",
            "platformBuildID", "valid")],
        F.array_join("histogram_names", ",").alias("names"), "hist_name", F.size("h.values").alias("n_values"),
        weighted.alias("weighted"), F.col("h.count").alias("count"), F.col("h.sum").alias("sum"),
        F.col("h.bucket_count").alias("bucket_count"), F.get("h.range", F.lit(0)).alias("low"),
        F.get("h.range", F.lit(1)).alias("high"), F.col("h.histogram_type").alias("histogram_type"),
    )


@query
def stored_daily_aggregates(spark, sf_dir):
    """The same totals from the stored histogram table instead of the documents."""
    path = fresh_path(spark, "tables")
    tables.write_tables(submissions(spark, sf_dir), path)
    return tables.daily_aggregates(tables.read_table(spark, path, "hist"), ALL_PRODUCTS, DEFAULT_REASONS)


@query
def kept_month_totals(spark, sf_dir):
    """States of all days, one of them first made from half of its submissions and then run again; months by their view."""
    rows, path = submissions(spark, sf_dir), fresh_path(spark, "states")
    kept.update(rows.where((F.col("d") != END) | (F.length("json") % 2 == 0)), ALL_PRODUCTS, path)
    kept.update(store.in_date_range(rows, END, END), ALL_PRODUCTS, path)
    kept.create_view(spark, path, "kept_months")
    return spark.table("kept_months")


@query
def unfit_totals(spark, sf_dir):
    """Names whose sums, made large, do not fit 64 bits, with the exact total."""
    rows = jobs.histogram_rows(submissions(spark, sf_dir), ALL_PRODUCTS).withColumn("sum", F.col("sum") * (1 << 40))
    found = histograms.unfit_totals(rows, ["hist_name"])
    return found.select("hist_name", F.col("sum_sum").cast("string").alias("sum_sum"), "doc_count")


# Slow SQL

@query
def slowsql_quantiles(spark, sf_dir):
    report = slowsql.quantile_report(jobs.slow_sql_rows(submissions(spark, sf_dir)))
    return report.select(*slowsql.REPORT_KEYS, "doc_count", "sum_count", *[_six(q).alias(q) for q in slowsql.SLOW_SQL_QUANTILES])


@query
def slowsql_quantiles_approx(spark, sf_dir):
    return slowsql.approximate_report(jobs.slow_sql_rows(submissions(spark, sf_dir)))


@query
def slowsql_quantiles_selected(spark, sf_dir):
    """The same quantiles by counting passes, without a sort of the values."""
    report = slowsql.selected_report(jobs.slow_sql_rows(submissions(spark, sf_dir)))
    return report.select(*slowsql.REPORT_KEYS, "doc_count", "sum_count", *[_six(q).alias(q) for q in slowsql.SLOW_SQL_QUANTILES])


def _sketched(spark, sf_dir):
    """Statement rows of all days, and their states stored by day, one day of them written twice."""
    rows, path = stage(jobs.slow_sql_rows(submissions(spark, sf_dir)), "statements"), fresh_path(spark, "sketches")
    sketches.write_daily_states(rows, path)
    sketches.write_daily_states(rows.where(F.col("d") == END), path)
    return rows, sketches.read_daily_states(spark, path)


@query
def slowsql_sketch_report(spark, sf_dir):
    """States of all days, merged over a week: counts and ends, which a sketch keeps exactly."""
    report = sketches.merged_report(_sketched(spark, sf_dir)[1], START, END, MIN_DOCS)
    return report.select(*sketches.RANGE_KEYS, "doc_count", F.col("sum_count").cast("bigint").alias("sum_count"), "n", _six("q0").alias("q0"), _six("q100").alias("q100"))


@query
def slowsql_sketch_errors(spark, sf_dir):
    """Quantiles of whole threads over a week, merged from the daily states, against exact ranks: none beyond the bound."""
    rows, states = _sketched(spark, sf_dir)
    report = sketches.merged_report(states, START, END, keys=["thread"])
    exact = slowsql.with_average(store.in_date_range(rows, START, END))
    off = sketches.rank_errors(exact, report, ["thread"], "avg_time")
    return off.join(report.select("thread", "n"), "thread").select("thread", "quantile", "n", (F.col("off") > sketches.rank_error()).alias("beyond"))


@query
def slowsql_report(spark, sf_dir):
    """Privacy correction first, as in daily use; the threshold suits the small tables."""
    report = jobs.slow_sql_report(submissions(spark, sf_dir), MIN_DOCS, scrub=True)
    return report.select(*slowsql.REPORT_KEYS, "doc_count", "sum_count", *[_six(q).alias(q) for q in slowsql.SLOW_SQL_QUANTILES])


@query
def privacy_scrub(spark, sf_dir):
    """Changed documents, with their statements read back from the new JSON."""
    changed = slowsql.scrub(submissions(spark, sf_dir))
    return slowsql.statements(docs.parse(changed, "slowSQL"), ["k"])


# Validation

@query
def spec_version_match(spark, sf_dir):
    rows = docs.parse(submissions(spark, sf_dir), "info").select("k", docs.info("appVersion").alias("product_version"))
    matched = validation.match_versions(rows, data.specification(spark))
    return matched.select("k", "product_version", "spec_key")


@query
def validate_histograms(spark, sf_dir):
    return validation.check_rows(submissions(spark, sf_dir), data.specification(spark)).select(
        "k", "spec_key", "hist_name", "valid", *validation.CHECKS
    )


@query
def validate_docs(spark, sf_dir):
    """Validated documents, with the verdicts read back from the new JSON."""
    done = validation.validate(submissions(spark, sf_dir), data.specification(spark))
    back = docs.parse(done, "info", "histograms")
    verdicts = F.transform_values("histograms", lambda _, h: docs.get("valid", "string", h))

    def named(wanted):
        return F.array_join(F.array_sort(F.map_keys(F.map_filter(verdicts, lambda _, v: v == wanted))), ",")

    return back.select(
        "k", docs.info("validForSchema").alias("valid_for_schema"), docs.info("appName").alias("product"),
        named("true").alias("passed"), named("false").alias("failed"), F.size("histograms").alias("n_histograms"),
    )


@query
def validation_report(spark, sf_dir):
    return validation.report(submissions(spark, sf_dir), data.specification(spark))


@query
def validation_write_back(spark, sf_dir):
    """Submissions of a store validated into another one; the counters come from the same pass."""
    source, target = fresh_path(spark, "store"), fresh_path(spark, "validated")
    store.write_store(submissions(spark, sf_dir), source)
    return jobs.validate_store(store.read_store(spark, source), data.specification(spark), target)


# Counts by configuration

@query
def flash_versions(spark, sf_dir):
    return jobs.flash_versions(submissions(spark, sf_dir), [DESKTOP, TOUCH], os="WINNT")


@query
def mobile_flash_versions(spark, sf_dir):
    return jobs.flash_versions(submissions(spark, sf_dir), [MOBILE])


@query
def oom_killed_counts(spark, sf_dir):
    return jobs.oom_killed_counts(submissions(spark, sf_dir), [MOBILE])


# Hangs

@query
def symbolicate_frames(spark, sf_dir):
    frames = hangs.frames(hangs.select_hangs(submissions(spark, sf_dir)))
    return hangs.symbolicate(frames, data.symbols(spark, sf_dir))


@query
def hang_report(spark, sf_dir):
    report = jobs.hang_report(submissions(spark, sf_dir), data.symbols(spark, sf_dir))
    return report.select(
        "d", "uuid", "lookups", "errors", F.array_join("hang_stacks", "|").alias("hang_stacks"),
        F.array_join("late_write_stacks", "|").alias("late_write_stacks"),
        F.get_json_object("metadata", "$.info.appName").alias("product"),
        F.get_json_object("metadata", "$.histograms").isNotNull().alias("has_histograms"),
    )


@query
def hang_text_report(spark, sf_dir):
    """The report as compressed text, read back: its lines, those of documents without the metadata."""
    path = fresh_path(spark, "hang-report")
    hangs.write_text_report(jobs.hang_report(submissions(spark, sf_dir), data.symbols(spark, sf_dir)), path)
    line = F.when(F.col("value").contains("\t"), F.substring_index("value", "\t", 2)).otherwise(F.col("value"))
    return spark.read.text(path).where("value <> ''").groupBy(line.alias("line")).agg(F.count("*").alias("n"))


# Ad-hoc queries

@query
def adhoc_query(spark, sf_dir):
    return jobs.adhoc_query(
        submissions(spark, sf_dir), START, END, [("firstPaint", None, ">", 1000), ("appVersion", None, "!=", "null")],
        0.5, ["info.appName", "simpleMeasurements.firstPaint", "histograms.CYCLE_MS"],
    )


@query
def shutdown_times(spark, sf_dir):
    return jobs.shutdown_times(submissions(spark, sf_dir), START, END).drop("k")


# Statistics

@query
def two_level_average(spark, sf_dir):
    out = jobs.cycle_collector_averages(data.cycle_collector_extract(spark, sf_dir))
    return out.select("date", "os", _six("avg_time").alias("avg_time"), _six("median_time").alias("median_time"), "sum_count")


@query
def gc_ratio_stats(spark, sf_dir):
    out = jobs.gc_ratio_stats(_from_file(data.gc_extract(spark, sf_dir), GC_UPTIME_DDL))
    return out.select("date", "version", *[_six(c).alias(c) for c in out.columns[2:]])


@query
def group_stats(spark, sf_dir):
    out = jobs.slow_sql_stats(_from_file(data.slow_sql_extract(spark, sf_dir), SLOW_SQL_DDL))
    return out.select("sql", *[_six(c).alias(c) for c in out.columns[1:]]).orderBy(F.desc("median_avg_time"), "sql")


@query
def slow_sql_by_time(spark, sf_dir):
    out = jobs.slow_sql_by_time(_from_file(data.slow_sql_extract(spark, sf_dir), SLOW_SQL_DDL))
    return out.select("sql", "count", "time", _six("avg_time").alias("avg_time"), "idx")


@query
def slow_sql_by_count(spark, sf_dir):
    out = jobs.slow_sql_by_count(_from_file(data.slow_sql_extract(spark, sf_dir), SLOW_SQL_DDL))
    return out.select("sql", "count", _six("median_avg_time").alias("median_avg_time"), "idx")


def _typed_slow_sql(spark, sf_dir):
    return data.slow_sql_extract(spark, sf_dir).select(
        "sql", F.col("count").cast("bigint").alias("count"), F.col("time").cast("bigint").alias("time")
    )


@query
def mean_ratio_by_sql(spark, sf_dir):
    out = jobs.mean_ratio_by_sql(_typed_slow_sql(spark, sf_dir))
    return out.select("sql", "count", _six("avg_time").alias("avg_time"))


@query
def rank_by_ratio(spark, sf_dir):
    out = jobs.mean_ratio_by_sql(_typed_slow_sql(spark, sf_dir)).select("sql", _six("avg_time").alias("avg_time"))
    return ranking.row_numbers(out, ["avg_time", "sql"])


@query
def top_n(spark, sf_dir):
    out = jobs.mean_ratio_by_sql(_typed_slow_sql(spark, sf_dir)).select("sql", "count", _six("avg_time").alias("avg_time"))
    return out.orderBy(F.desc("avg_time"), "sql").limit(20)


@query
def corr_pearson(spark, sf_dir):
    rows = data.first_paint_extract(spark, sf_dir).where("version = '10.0a1' and os = 'WINNT' and osversion = '6.1'")
    rows = rows.where("firstpaint is not null and places is not null")
    return statistics.pearson(rows, "firstpaint", "places").select(_six("pearson").alias("pearson"))


@query
def corr_spearman(spark, sf_dir):
    rows = data.first_paint_extract(spark, sf_dir).where("version = '10.0a1' and os = 'WINNT' and osversion = '6.1'")
    return statistics.spearman(rows, "firstpaint", "places").select(_six("spearman").alias("spearman"))


@query
def histogram_bins(spark, sf_dir):
    out = jobs.cohort_bins(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT", "6.1")
    return out.select("si", "lower", "upper", "n", F.round("density", 9).alias("density"))


@query
def six_number_summary(spark, sf_dir):
    out = statistics.six_numbers(data.first_paint_extract(spark, sf_dir), ["version", "os"], "sessionrestored")
    return out.select("version", "os", "n_values", *[_six(c).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")], "missing")


@query
def cohort_summary(spark, sf_dir):
    out = jobs.cohort_summary(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT", "6.1")
    return out.select("si", "n_values", *[_six(c).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")], "missing")


@query
def ecdf(spark, sf_dir):
    out = jobs.cohort_distribution(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT", "6.1", 0)
    return out.select(F.col("firstpaint").cast("bigint").alias("firstpaint"), "n", _six("ecdf").alias("ecdf"))


@query
def kernel_density(spark, sf_dir):
    rows = jobs.cohort_rows(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT", "6.1").where("si = 0")
    out = statistics.kernel_density(rows, "firstpaint")
    return out.select("i", F.round("x", 4).alias("x"), F.round("density", 10).alias("density"))


@query
def submission_trend(spark, sf_dir):
    """Daily volume written as a tab-separated extract, read back and scaled."""
    stats = jobs.submission_stats(submissions(spark, sf_dir), by_product=True)
    stats = stats.select("d", "product", "product_version", "count", "sum_size", "avg_size")
    extract = _from_file(stats, SUBMISSION_STATS_DDL)
    out = jobs.submission_trend(extract, DESKTOP, ["16.0", "18.0.1", "9.0"])
    return out.select("date", "version", "version_major", "count", _six("avg_size_kb").alias("avg_size_kb"),
                      F.round("sum_size_gb", 9).alias("sum_size_gb"))


@query
def corr_second_pair(spark, sf_dir):
    """Both correlations of the other pair of measurements."""
    rows = data.first_paint_extract(spark, sf_dir).where("version = '10.0a1' and os = 'WINNT' and osversion = '6.1'")
    rows = rows.where("firstpaint is not null and ndco is not null")
    both = statistics.pearson(rows, "firstpaint", "ndco").select(F.lit("pearson").alias("method"), F.col("pearson").alias("value")).unionByName(
        statistics.spearman(rows, "firstpaint", "ndco").select(F.lit("spearman").alias("method"), F.col("spearman").alias("value")))
    return both.select("method", _six("value").alias("value"))


@query
def late_paint_bins(spark, sf_dir):
    out = jobs.late_paint_bins(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT")
    return out.select("lower", "upper", "n", F.round("density", 12).alias("density"))


@query
def cohort_restored_summary(spark, sf_dir):
    out = jobs.cohort_summary(data.first_paint_extract(spark, sf_dir), "10.0a1", "WINNT", "6.1", "sessionrestored")
    return out.select("si", "n_values", *[_six(c).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")], "missing")


@query
def saved_ping_files(spark, sf_dir):
    """All saved pings as files of one document each, read back whole."""
    path = fresh_path(spark, "pings")
    # Else the condition goes down to the events' file, and each document is built there once more, in a task per row group.
    pings = docs.once(submissions(spark, sf_dir), "d", "json").where("json is not null")
    payload = pings.select(F.to_json(F.struct("d", F.col("json").alias("payload"))).alias("value"))
    store.write_ping_files(payload, path)
    return store.stage_pings(spark, path, lambda payloads: payloads.select("k", F.md5("json").alias("digest")))


@query
def saved_ping_lines(spark, sf_dir):
    """All saved pings, one document per line, read back whole."""
    path = fresh_path(spark, "pings")
    pings = submissions(spark, sf_dir).where("json is not null")
    pings.select(F.to_json(F.struct("d", F.col("json").alias("payload"))).alias("value")).write.text(path)
    return store.read_ping_payloads(spark, path, lines=True).select("k", F.md5("json").alias("digest"))
