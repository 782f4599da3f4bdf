"""Checks of histograms against versioned specifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldlens.functions.documents import as_map, bind, info, is_object, once, parse, top_level
from fieldlens.schema import HISTOGRAM_DDL, VARIANT_MAP_DDL
from fieldlens.session import stage

DEFAULT_SPEC = "default"

SLOTS = 256  # a version's histograms are looked up by a hash of the name

CHECKS = ["bad_type", "bad_min", "bad_max", "bad_bucket_count", "no_buckets", "bad_bucket"]


def version_keys(spec: DataFrame) -> Column:
    """All version keys as one constant array, the longest first; there is one key per supported release."""
    found = {row[0] for row in spec.select("version_key").distinct().collect()} - {None}
    ordered = sorted(found, key=lambda key: (-len(key), key))
    return F.array(*[F.lit(key) for key in ordered]).cast("array<string>")


def spec_key(version: Column, keys: Column) -> Column:
    """Longest version key contained in the version, else the default where there is one."""
    fallback = F.when(F.array_contains(keys, DEFAULT_SPEC), DEFAULT_SPEC)
    chosen = F.get(F.filter(keys, lambda key: version.contains(key)), F.lit(0))
    return F.when(version.isNotNull(), F.coalesce(chosen, fallback))


def match_versions(df: DataFrame, spec: DataFrame, version: str = "product_version") -> DataFrame:
    """Add ``spec_key``. The keys are one value, so no row is paired with each key."""
    return df.withColumn("spec_key", spec_key(F.col(version), version_keys(spec)))


def _as_text(value: Column) -> Column:
    """Leaf as text, ``null`` for JSON null and empty when absent."""
    text = F.when(F.is_variant_null(value), "null").otherwise(F.try_variant_get(value, F.lit("$"), "string"))
    return F.coalesce(text, F.lit(""))


def typed(value: Column) -> Column:
    return F.try_variant_get(value, F.lit("$"), HISTOGRAM_DDL)


def _edge_text(edge: Column) -> Column:
    return F.concat(F.lit(","), edge.cast("string"), F.lit(","))


def _edges(buckets: Column) -> Column:
    """Bucket edges as one text, ``,0,1,2,``: it is searched at once, an array number by number.

    NULL, so that no bucket is judged, without buckets or with a NULL among them.
    """
    whole = ~F.exists(buckets, lambda b: b.isNull())
    return F.when(whole, _edge_text(F.array_join(buckets.cast("array<string>"), ",")))


def checks(hist: Column, spec: Column) -> Column:
    """Struct of failed checks for one typed histogram against its specification struct."""

    def differs(expected, found):
        return ~F.coalesce(expected == found, F.lit(False))

    keys = F.map_keys(hist["values"])

    def edge(key):
        number = F.when(key.rlike(r"^[+-]?[0-9]+$"), key.try_cast("int"))
        return F.coalesce(number, F.lit(-1))

    empty = F.coalesce(F.size(keys), F.lit(0)) == 0
    stray = F.exists(keys, lambda key: ~spec["edges"].contains(_edge_text(edge(key))))
    return bind(F.try_variant_get(hist["range"], F.lit("$"), "array<variant>"), lambda limits: F.struct(
        differs(spec["hist_type"], _as_text(hist["histogram_type"])).alias("bad_type"),
        differs(spec["min"], _as_text(F.get(limits, F.lit(0)))).alias("bad_min"),
        differs(spec["max"], _as_text(F.get(limits, F.lit(1)))).alias("bad_max"),
        differs(spec["bucket_count"], _as_text(hist["bucket_count"])).alias("bad_bucket_count"),
        empty.alias("no_buckets"),
        F.coalesce(~empty & stray, F.lit(False)).alias("bad_bucket"),
    ))


def passed(result: Column) -> Column:
    out = F.lit(True)
    for name in CHECKS:
        out = out & ~result[name]
    return out


def readable(json: str = "json") -> Column:
    """The text is a JSON object."""
    return top_level(json).isNotNull()


#: What a document's other members may hold that only reading them as values shows: numbers of a thousand digits, and their size.
LONG_NUMBER, LARGE_TEXT = "[0-9.eE+-]{1000}", 1 << 24


def _readable_after(unread: str, json: str) -> Column:
    """As :func:`readable`, for a text parsed with ``unread``: the whole document is read again only in doubt."""
    read = F.col(unread).isNull() & (F.octet_length(json) < LARGE_TEXT) & ~F.col(json).rlike(LONG_NUMBER)
    return F.when(~F.ltrim(json).startswith("{") | F.col(json).isNull(), False).when(read, True).otherwise(readable(json))


def _slot(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(SLOTS)).cast("int")


def folded(spec: DataFrame) -> DataFrame:
    """The specification with one row per version: (spec_key, slots), entries in slots by a hash of their name.

    It is written, so that its size is known: Spark sends it to all tasks where it is small, else it joins.
    """
    entry = F.struct("hist_name", "min", "max", "hist_type", "bucket_count", _edges(F.col("buckets")).alias("edges"))
    slots = spec.groupBy(F.col("version_key").alias("spec_key"), _slot(F.col("hist_name")).alias("slot")).agg(F.collect_list(entry).alias("entries"))
    by_slot = slots.groupBy("spec_key").agg(F.map_from_entries(F.collect_list(F.struct("slot", "entries"))).alias("found"))
    every = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.element_at("found", i))
    return stage(by_slot.select("spec_key", every.alias("_slots")), "spec")


def _with_spec(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Add ``spec_key`` and the entries of that version to documents with a parsed ``info``.

    A document meets one row at most, so it stays one row, whatever its key.
    """
    matched = once(df, *df.columns, spec_key(info("appVersion"), version_keys(spec)).alias("spec_key"))
    return matched.join(folded(spec), "spec_key", "left")


def _outcome(name: Column, value: Column) -> Column:
    """Struct of ``known`` and the checks, judged inside the document; without entry the checks are NULL."""
    entry = F.get(F.filter(F.get("_slots", _slot(name)), lambda e: e["hist_name"] == name), F.lit(0))
    return bind(entry, lambda known: F.struct(
        known.isNotNull().alias("known"),
        F.when(known.isNotNull(), bind(typed(value), lambda hist: checks(hist, known))).alias("checks"),
    ))


def _outcomes() -> Column:
    return F.transform(F.map_entries("histograms"), lambda e: F.struct(
        e["key"].alias("hist_name"), _outcome(e["key"], e["value"]).alias("outcome")
    ))


def _columns() -> list[Column]:
    found = F.col("_one.outcome.checks")
    return [
        F.col("_one.hist_name").alias("hist_name"), F.col("_one.outcome.known").alias("known"),
        *[found[c].alias(c) for c in CHECKS], F.when(F.col("_one.outcome.known"), passed(found)).alias("valid"),
    ]


def check_rows(df: DataFrame, spec: DataFrame) -> DataFrame:
    """One row per histogram of each evaluated document with the outcome of every check.

    ``valid`` is NULL for histograms that the specification does not know.
    """
    parsed = _with_spec(parse(df, "info", "histograms").where(info("appVersion").isNotNull()), spec)
    judged = once(parsed, "k", "spec_key", _outcomes().alias("_all"))
    rows = judged.select("k", "spec_key", F.explode("_all").alias("_one"))
    columns = _columns()
    return rows.select("k", columns[0], "spec_key", *columns[1:])


#: Counters of a validation run, in report order, beside the number of documents.
DOCUMENT_COUNTERS = ["meta_data_invalid", "invalid_json_structure", "submissions_evaluated"]
HISTOGRAM_COUNTERS = {
    "known_histograms": "known", "unknown_histograms": "unknown", "invalid_histogram_type": "bad_type", "invalid_histogram_min": "bad_min",
    "invalid_histogram_max": "bad_max", "invalid_histogram_bucket_count": "bad_bucket_count", "no_histogram_bucket_values": "no_buckets",
    "invalid_histogram_bucket_value": "bad_bucket", "valid_histogram": "valid", "invalid_histogram": "invalid",
}


def _document_counts(json: str) -> Column:
    """What one document adds to each counter; ``_all`` has its outcomes."""
    evaluated = info("appVersion").isNotNull()

    def found(name: str) -> Column:
        def holds(entry: Column) -> Column:
            known, checks = entry["outcome"]["known"], entry["outcome"]["checks"]
            judged = {"known": known, "unknown": ~known, "valid": known & passed(checks), "invalid": known & ~passed(checks)}
            return judged[name] if name in judged else checks[name]

        return F.size(F.filter("_all", holds)).cast("bigint")

    one = lambda condition: F.when(condition, 1).otherwise(0).cast("bigint")
    counted = {
        "meta_data_invalid": one(F.col(json).isNull()), "invalid_json_structure": one(F.col(json).isNotNull() & F.col("_top").isNull()),
        "submissions_evaluated": one(evaluated), **{name: F.when(evaluated & F.col("_all").isNotNull(), found(t)).otherwise(0) for name, t in HISTOGRAM_COUNTERS.items()},
    }
    return F.struct(*[value.alias(name) for name, value in counted.items()])


def report(df: DataFrame, spec: DataFrame, json: str = "json") -> DataFrame:
    """Counters of a validation run in one row; documents are read once, damaged ones twice.

    Every document gives one row per histogram and at least one row; its first row counts it.
    """
    version = info("appVersion")
    parsed = _with_spec(parse(df, "info", "histograms", json=json, unread="_unread"), spec)
    judged = once(
        parsed, F.col(json).isNull().alias("null_json"), _readable_after("_unread", json).alias("is_object"),
        version.isNotNull().alias("evaluated"), F.when(version.isNotNull(), _outcomes()).alias("_all"),
    )
    rows = judged.select("null_json", "is_object", "evaluated", F.posexplode_outer("_all").alias("place", "_one"))
    rows = rows.select("null_json", "is_object", "evaluated", "place", *_columns())
    first = F.coalesce(F.col("place"), F.lit(0)) == 0
    return rows.agg(
        F.count_if(first).alias("documents"),
        F.count_if(first & F.col("null_json")).alias("meta_data_invalid"),
        F.count_if(first & ~F.col("null_json") & ~F.col("is_object")).alias("invalid_json_structure"),
        F.count_if(first & F.col("evaluated")).alias("submissions_evaluated"),
        F.count_if(F.col("known")).alias("known_histograms"),
        F.count_if(~F.col("known") & F.col("hist_name").isNotNull()).alias("unknown_histograms"),
        F.count_if("bad_type").alias("invalid_histogram_type"),
        F.count_if("bad_min").alias("invalid_histogram_min"),
        F.count_if("bad_max").alias("invalid_histogram_max"),
        F.count_if("bad_bucket_count").alias("invalid_histogram_bucket_count"),
        F.count_if("no_buckets").alias("no_histogram_bucket_values"),
        F.count_if("bad_bucket").alias("invalid_histogram_bucket_value"),
        F.count_if("valid").alias("valid_histogram"),
        F.count_if(~F.col("valid")).alias("invalid_histogram"),
    )


def with_validated(df: DataFrame, spec: DataFrame, out: str = "new_json", counts: str | None = None) -> DataFrame:
    """Add ``is_valid`` and the document with the verdicts written into it.

    Known histograms get ``valid``; ``info.validForSchema`` says whether all of them passed. A
    document without application version or histograms is not valid; text that is not a JSON object
    gives NULL. A missing ``info`` object is created. ``counts`` names a column for what each document adds to
    the counters of the run.
    """
    parsed = _with_spec(parse(df, "info", "histograms"), spec)

    def verdict(name, value):
        return bind(_outcome(name, value), lambda o: F.when(o["known"], passed(o["checks"])))

    if counts:  # the outcomes are kept whole, and the verdicts taken from them
        judged = once(parsed, *df.columns, "info", "histograms", _outcomes().alias("_all"), top_level().alias("_top"))
        verdicts = F.map_from_entries(F.transform("_all", lambda e: F.struct(e["hist_name"], F.when(e["outcome"]["known"], passed(e["outcome"]["checks"])))))
        ready = once(judged, *df.columns, "info", "histograms", verdicts.alias("_verdicts"), "_top", _document_counts("json").alias(counts))
    else:
        verdicts = F.transform_values("histograms", verdict).alias("_verdicts")
        ready = once(parsed, *df.columns, "info", "histograms", verdicts, top_level().alias("_top"))
    histograms = F.col("histograms")
    text_true, text_false = F.lit("true").cast("variant"), F.lit("false").cast("variant")

    def marked(name, value):
        def with_flag(verdict):
            fields = F.map_concat(
                as_map(value), F.create_map(F.lit("valid"), F.when(verdict, text_true).otherwise(text_false))
            )
            return F.when(verdict.isNotNull() & is_object(value), F.to_variant_object(fields)).otherwise(value)

        return bind(F.col("_verdicts")[name], with_flag)

    evaluated = info("appVersion").isNotNull() & histograms.isNotNull()
    all_passed = ~F.coalesce(F.exists(F.map_values("_verdicts"), lambda v: ~v), F.lit(False))
    valid = evaluated & all_passed
    no_fields = F.create_map().cast(VARIANT_MAP_DDL)
    new_info = F.map_concat(
        F.map_filter(F.coalesce(as_map(F.col("info")), no_fields), lambda name, _: name != "validForSchema"),
        F.create_map(F.lit("validForSchema"), F.when(valid, text_true).otherwise(text_false)),
    )
    new_histograms = F.when(
        evaluated,
        F.create_map(F.lit("histograms"), F.to_variant_object(F.transform_values(histograms, marked))),
    ).otherwise(F.map_filter("_top", lambda name, _: name == "histograms"))
    new_top = F.map_concat(
        F.map_filter("_top", lambda name, _: ~name.isin("histograms", "info")),
        new_histograms,
        F.create_map(F.lit("info"), F.to_variant_object(new_info)),
    )
    has_top = F.col("_top").isNotNull()
    return once(
        ready, *df.columns, *([counts] if counts else []), F.when(has_top, valid).alias("is_valid"),
        F.when(has_top, F.to_json(new_top)).alias(out),
    )


def observed(df: DataFrame, spec: DataFrame, out: str = "new_json") -> tuple[DataFrame, Observation]:
    """As :func:`with_validated`, with the counters of :func:`report` gathered while the rows are written.

    The counters are there once one action over the rows has ended. Write them without a shuffle in between: a
    task of the writing stage counts once, also when it ran again or twice, a task before a shuffle may not.
    """
    seen, own = Observation(), "_counts"
    judged = with_validated(df, spec, out, own)
    names = [*DOCUMENT_COUNTERS, *HISTOGRAM_COUNTERS]
    sums = [F.coalesce(F.sum(F.col(own)[name]), F.lit(0).cast("bigint")).alias(name) for name in names]
    return judged.observe(seen, F.count(F.lit(1)).alias("documents"), *sums).drop(own), seen


def validate(df: DataFrame, spec: DataFrame) -> DataFrame:
    """Key, verdict and new JSON of every submission that is a JSON object."""
    judged = with_validated(df, spec).where(F.col("new_json").isNotNull())
    return judged.select("k", "is_valid", F.col("new_json").alias("json"))
