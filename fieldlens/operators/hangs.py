"""Hang and late-write stacks: frames, symbol lookup and the hang report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.documents import get, once, parse, size_of, top_level
from fieldlens.functions.predicates import has_stacks
from fieldlens.functions.scalars import day_from_key, uuid_from_key
from fieldlens.operators.ranking import nearest_below
from fieldlens.session import stage

PARTS = {"hang": "chromeHangs", "late_write": "lateWrites"}


def select_hangs(df: DataFrame) -> DataFrame:
    """Submissions with a hang or late write that has a memory map; both parts are added as columns."""
    parsed = parse(df, *PARTS.values())
    return parsed.where(has_stacks(F.col("chromeHangs")) | has_stacks(F.col("lateWrites")))


def _text(row: Column, i: int) -> Column:
    return F.try_variant_get(row, F.lit(f"$[{i}]"), "string")


def _module(row: Column) -> Column:
    """Module name and debug id of a memory map row.

    Rows of two hold both as they are; rows of four hold file, age, GUID and symbol file, and the
    debug id is the bare GUID followed by the age.
    """
    width = F.array_size(F.try_variant_get(row, F.lit("$"), "array<variant>"))
    guid = F.upper(F.regexp_replace(_text(row, 2), "[{}-]", ""))
    age = F.hex(_text(row, 1).try_cast("bigint"))
    return F.struct(
        F.when(width == 2, _text(row, 0)).when(width == 4, _text(row, 3)).alias("module"),
        F.when(width == 2, _text(row, 1)).when(width == 4, F.concat(guid, age)).alias("debug_id"),
    )


def _stacks(part: str) -> Column:
    """Stacks as arrays of ``[module index, offset]`` from either layout of the part."""
    value = F.col(part)
    listed = F.transform(
        F.try_variant_get(value, F.lit("$"), "array<variant>"),
        lambda hang: F.try_variant_get(hang, F.lit("$.stack"), "array<array<bigint>>"),
    )
    return F.coalesce(get(["stacks"], "array<array<array<bigint>>>", value), listed)


def frames(df: DataFrame) -> DataFrame:
    """One row per stack frame: key, kind, stack and frame number, module, debug id, offset.

    Modules are looked up inside the document, so the memory map is not repeated per frame.
    """
    kinds = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), _stacks(part).alias("stacks"),
            F.transform(get(["memoryMap"], "array<variant>", part), _module).alias("modules"),
        )
        for kind, part in PARTS.items()
    ])
    by_kind = once(df, "k", kinds.alias("_kinds")).select("k", F.inline("_kinds"))

    def placed(frame):
        index = F.get(frame, F.lit(0)).try_cast("int")
        owner = F.when(index >= 0, F.get("modules", index))
        return F.struct(
            owner["module"].alias("module"), owner["debug_id"].alias("debug_id"), F.get(frame, F.lit(1)).alias("offset")
        )

    stacks = F.transform("stacks", lambda stack: F.transform(stack, placed))
    by_kind = once(by_kind, "k", "kind", stacks.alias("_stacks"))
    by_stack = by_kind.select("k", "kind", F.posexplode("_stacks").alias("stack_no", "_stack"))
    by_frame = by_stack.select("k", "kind", "stack_no", F.posexplode("_stack").alias("frame_no", "_frame"))
    return by_frame.select("k", "kind", "stack_no", "frame_no", "_frame.*")


def symbolicate(frame_rows: DataFrame, symbols: DataFrame, **options) -> DataFrame:
    """Name each frame after the nearest symbol at or below its offset.

    The same offsets recur in very many stacks, so the ordered lookup runs on distinct offsets only
    and the names are joined back. Frames without a module, or below the first symbol, stay unnamed;
    the former, often a large share, keep out of the join.
    """
    frame_rows = stage(frame_rows, "frames")
    known = F.col("module").isNotNull() & F.col("debug_id").isNotNull() & F.col("offset").isNotNull()
    placed = frame_rows.where(known)
    distinct = placed.select("module", "debug_id", "offset").distinct()
    named = nearest_below(distinct, symbols, ["module", "debug_id"], "offset", "start", "name", **options)
    columns = ["k", "kind", "stack_no", "frame_no", "module", "debug_id", "offset"]
    joined = placed.join(named, ["module", "debug_id", "offset"], "left")
    return joined.select(*columns, F.col("name").alias("symbol")).unionByName(
        frame_rows.where(~known).select(*columns, F.lit(None).cast("string").alias("symbol"))
    )


def _has_part(part: str) -> Column:
    """The part holds anything: a non-empty object or list."""
    return F.coalesce(size_of([], F.col(part)), F.lit(0)) > 0


def hang_report(df: DataFrame, symbols: DataFrame, **options) -> DataFrame:
    """Per document with hangs: its other content and its named stacks as text.

    ``lookups`` counts parts that were looked up, ``errors`` those that gave no stack. Unnamed
    frames appear as hexadecimal offsets. What is collected per row are the frames of one document.
    """
    # Few submissions hold hangs: they are found once and kept, not looked for again in each branch.
    # They are told apart by a number of their own, as a key may come twice.
    found = select_hangs(df).select(F.col("k").alias("key"), "json").withColumn("k", F.monotonically_increasing_id().cast("string"))
    hangs = parse(stage(found, "hangs"), *PARTS.values())
    named = symbolicate(frames(hangs), symbols, **options)
    label = F.coalesce("symbol", F.concat(F.lit("0x"), F.lower(F.hex("offset"))))
    per_stack = named.groupBy("k", "kind", "stack_no").agg(
        F.sort_array(F.collect_list(F.struct("frame_no", label.alias("label")))).alias("named")
    )
    lines = F.array_join(F.transform("named", lambda f: f["label"]), "\n")

    def stacks_of(kind):
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("stack_no", lines.alias("text")))))

    per_document = per_stack.groupBy("k").agg(*[stacks_of(kind).alias(kind) for kind in PARTS])
    dropped = [*PARTS.values(), "histograms"]
    rest = F.map_filter(top_level(), lambda name, _: ~name.isin(*dropped))
    looked_up = [F.when(_has_part(part), 1).otherwise(0) for part in PARTS.values()]
    without = [
        F.when(_has_part(part) & (F.coalesce(F.size(_stacks(part)), F.lit(0)) == 0), 1).otherwise(0)
        for part in PARTS.values()
    ]
    documents = hangs.select(
        "k", "key", F.to_json(rest).alias("metadata"),
        sum(looked_up[1:], looked_up[0]).alias("lookups"), sum(without[1:], without[0]).alias("errors"),
    )
    none = F.array().cast("array<string>")

    def texts(kind):
        return F.coalesce(F.transform(kind, lambda s: s["text"]), none).alias(f"{kind}_stacks")

    return documents.join(per_document, "k", "left").select(
        day_from_key(F.col("key")).alias("d"), uuid_from_key(F.col("key")).alias("uuid"), "metadata",
        "lookups", "errors", *[texts(kind) for kind in PARTS],
    )


def as_text_report(report: DataFrame) -> DataFrame:
    """The hang report as lines of text, one value per document."""
    # The lines before and after a stack.
    def framed(kind, title):
        return F.array_join(
            F.transform(
                f"{kind}_stacks",
                lambda s: F.concat(F.lit(f"\n----- BEGIN {title} STACK -----\n"), s, F.lit(f"\n----- END {title} STACK -----\n")),
            ), "")

    return report.select(
        F.concat(
            F.concat_ws("\t", "d", "uuid", "metadata"), framed("hang", "HANG"), framed("late_write", "LATE WRITE")
        ).alias("value")
    )


def write_text_report(report: DataFrame, path: str, mode: str = "error") -> None:
    """The hang report as compressed text, the form in which it is handed out."""
    as_text_report(report).write.mode(mode).option("compression", "gzip").text(path)
