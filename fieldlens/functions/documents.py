"""Parsing of JSON documents and typed access to their parts.

Two forms are used. :func:`parse` reads only the named parts, each as its own value; jobs that fan a
document out use it, because a small part does not drag the field names of the whole document along.
:func:`parse_whole` keeps the whole document as one VARIANT for queries on arbitrary paths.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.scalars import day_from_key, null_default, os_version
from fieldlens.schema import DIMENSIONS, INFO_FIELDS, MISSING, PART_TYPES, PRESENT_DDL, VARIANT_MAP_DDL


def once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Select columns so that each is computed exactly once per row.

    The optimizer pushes filters through a plain projection, and it derives a non-empty filter from
    every later explode; both copy the projected expression, so that a document would be parsed, or
    an array built, several times per row. The output of a generator cannot be pushed through. The
    columns are computed in a projection of their own below it, where code is generated for them.
    """
    computed = df.select(*columns)
    return computed.select(F.explode(F.array(F.struct(*computed.columns))).alias("_row")).select("_row.*")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside a higher-order function.

    Generated code shares common subexpressions of a projection, but not those within a lambda.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _object_text(json: str) -> Column:
    return F.when(F.ltrim(json).startswith("{"), F.col(json))


def parse(df: DataFrame, *parts: str, json: str = "json", keep: Sequence[str] | None = None, unread: str | None = None,
          **typed: str) -> DataFrame:
    """Add the named top-level parts as columns; parts of another type than expected are NULL.

    ``keep`` names the columns of ``df`` to carry along, all by default; without the text there it is not
    copied next to its parts. ``typed`` gives a part another type than :data:`PART_TYPES`. Text that is not a JSON object has
    no parts. Of repeated keys the last counts. ``unread`` names a column for the text of an object that is broken
    or has a part of another type than expected, NULL for others.
    """
    types = {part: PART_TYPES[part] for part in parts} | typed
    schema = ", ".join(f"`{part}` {kind}" for part, kind in types.items())
    if unread:
        parsed = F.from_json(_object_text(json), f"{schema}, `{unread}` string", {"columnNameOfCorruptRecord": unread})
    else:
        parsed = F.from_json(_object_text(json), schema)
    kept = df.columns if keep is None else list(keep)
    rows = once(df, *kept, parsed.alias("_parsed"))
    parsed_parts = {part: F.col("_parsed")[part] for part in types}
    columns = [
        (_last_of_repeated(value) if types[part] == VARIANT_MAP_DDL else value).alias(part)
        for part, value in parsed_parts.items()
    ]
    return once(rows, *kept, *columns, *([F.col("_parsed")[unread].alias(unread)] if unread else []))


def _last_of_repeated(members: Column) -> Column:
    return F.map_concat(members, F.create_map().cast(VARIANT_MAP_DDL))


def parse_whole(df: DataFrame, json: str = "json", doc: str = "doc") -> DataFrame:
    """Add the whole document as one VARIANT; text that is not JSON gives NULL."""
    return once(df, *df.columns, F.try_parse_json(json).alias(doc))


def top_level(json: str = "json") -> Column:
    """Top-level members as a map, each a value of its own; NULL unless the text is an object."""
    return _last_of_repeated(F.from_json(_object_text(json), VARIANT_MAP_DDL))


def path(*steps: str) -> str:
    """Variant path to nested object fields, any name without a double quote."""
    for step in steps:
        if '"' in step:
            raise ValueError(f"field name holds a double quote: {step!r}")
    return "$" + "".join(f'["{step}"]' for step in steps)


def get(steps: str | Sequence[str], as_type: str = "string", doc: str | Column = "doc") -> Column:
    """Value under a dotted or split path; missing or of another type is NULL."""
    steps = steps.split(".") if isinstance(steps, str) else steps
    value = F.col(doc) if isinstance(doc, str) else doc
    return F.try_variant_get(value, F.lit(path(*steps)), as_type)


def as_map(value: Column) -> Column:
    """Object as a map of VARIANT, NULL for anything that is not an object."""
    return F.try_variant_get(value, F.lit("$"), VARIANT_MAP_DDL)


def is_object(value: Column) -> Column:
    """True for a VARIANT object; only an object casts to the empty struct."""
    return F.try_variant_get(value, F.lit("$"), "struct<>").isNotNull()


def is_map(steps: str | Sequence[str], doc: str | Column = "doc") -> Column:
    return get(steps, "struct<>", doc).isNotNull()


def is_present(value: Column) -> Column:
    """True for a VARIANT that exists and is not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def size_of(steps: str | Sequence[str], doc: str | Column = "doc") -> Column:
    """Number of elements of the array or object under the path, NULL for other values."""
    return F.coalesce(
        F.array_size(get(steps, "array<variant>", doc)),
        F.array_size(F.map_keys(get(steps, VARIANT_MAP_DDL, doc))),
    )


def number(value: Column, as_type: str) -> Column:
    """Numeric leaf of the given type; text, booleans, null and nested values give NULL."""
    kind = F.schema_of_variant(value)
    # Most numbers are whole, and those are read without a conversion inside the VARIANT.
    whole = F.when(kind == "BIGINT", F.try_variant_get(value, F.lit("$"), "bigint"))
    other = F.when(
        kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.try_variant_get(value, F.lit("$"), "double")
    )
    if as_type == "bigint":
        return F.coalesce(whole, other.try_cast("bigint"))
    return F.coalesce(whole.try_cast(as_type), other.try_cast(as_type))


def info(field: str) -> Column:
    """Field of the parsed ``info`` part as text."""
    return get([field], doc="info")


def info_fields(names: Sequence[str]) -> Column:
    """Fields of the parsed ``info`` part as one struct of texts, each as :func:`info` gives it.

    They are found in one pass over the members; a lookup of its own for each passes all members for every absent field.
    """
    return F.try_variant_get("info", F.lit("$"), f"struct<{', '.join(f'`{name}`: string' for name in names)}>")


def is_complete() -> Column:
    """The three main parts, parsed as columns, are all objects."""
    return is_object(F.col("info")) & F.col("histograms").isNotNull() & F.col("simpleMeasurements").isNotNull()


PRESENCE = {"histograms": PRESENT_DDL, "simpleMeasurements": PRESENT_DDL}


def dimension_columns(names: Sequence[str] = DIMENSIONS, key: str = "k") -> list[Column]:
    """The requested dimensions as named columns, with missing channel filled and OS version cut."""
    special = {
        "d": lambda: day_from_key(F.col(key)),
        "product_channel": lambda: null_default(info(INFO_FIELDS["product_channel"]), MISSING),
        "os_version": lambda: os_version(info(INFO_FIELDS["os_version"])),
    }
    return [
        (special[name]() if name in special else info(INFO_FIELDS[name])).alias(name)
        for name in names
    ]


def select_fields(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ("k",)) -> DataFrame:
    """Project dotted fields of the whole document; the last path step names the column.

    A field ``histograms.NAME`` turns into one row per non-empty bucket of that histogram.
    """
    from fieldlens.operators.histograms import single_histogram

    expanded = [f for f in fields if f.startswith("histograms.") and f.count(".") == 1]
    if len(expanded) > 1:
        raise ValueError("at most one histogram per projection; each would multiply the rows of the other")
    plain = [get(f).alias(f.rsplit(".", 1)[-1]) for f in fields if f not in expanded]
    if not expanded:
        return df.select(*keep, *plain)
    name = expanded[0].split(".", 1)[1]
    return single_histogram(df, name, get(["histograms", name], "variant"), [*keep, *plain])
