"""Predicates over documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.documents import get, info, is_object, number, size_of
from fieldlens.schema import DEFAULT_REASONS

COMPARISONS = {
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
}
NULL_TEXT = "null"


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def from_products(products: Sequence[str], reasons: Sequence[str] | None = DEFAULT_REASONS,
                  os: str | None = None) -> Column:
    """Submissions of the given products, reasons and operating system, by the parsed ``info``."""
    conditions = [info("appName").isin(*products)]
    if reasons:
        conditions.append(info("reason").isin(*reasons))
    if os:
        conditions.append(info("OS") == os)
    return all_of(conditions)


def has_stacks(part: Column) -> Column:
    """The part is an object with a non-empty memory map."""
    return is_object(part) & F.coalesce(size_of(["memoryMap"], part) > 0, F.lit(False))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value; NaN counts as missing."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def _on_number(value: Column, op: str, wanted: str) -> Column:
    try:
        literal = F.lit(float(wanted))
    except ValueError:
        return F.lit(False)
    return COMPARISONS[op](number(value, "double"), literal)


def _on_any(value: Column, op: str, wanted: str) -> Column:
    """Text and booleans by equality, numbers by any operator."""
    text = F.try_variant_get(value, F.lit("$"), "string")
    equality = COMPARISONS[op](text, F.lit(wanted)) if op in ("=", "!=") else text == wanted
    return F.when(number(value, "double").isNotNull(), _on_number(value, op, wanted)).otherwise(equality)


def compares(key: str, op: str, wanted, sub: str | None = None) -> Column:
    """Compare a measure, looked up in histograms, then simple measurements, then ``info``.

    For a histogram the bucket keys are compared, any of them may match; another ``sub`` names a
    numeric field of it. The value ``"null"`` tests absence with ``=`` and presence with ``!=``
    within the part that holds the key. A key found nowhere gives false.
    """
    if op not in COMPARISONS:
        raise ValueError(f"unknown comparison {op!r}")
    if isinstance(wanted, bool):
        wanted = str(wanted).lower()
    wanted = str(wanted)
    tests_null = wanted == NULL_TEXT and op in ("=", "!=")

    def null_test(value):
        missing = value.isNull() | F.is_variant_null(value)
        return missing if op == "=" else ~missing

    hist = get(["histograms", key], "variant")
    if sub is None or sub == "values":
        keys = F.map_keys(get(["histograms", key, "values"], "map<string, variant>"))
        if tests_null:
            on_histogram = F.size(keys) > 0 if op == "!=" else F.lit(False)
        else:
            number_of = lambda b: F.when(b.rlike(r"^[+-]?[0-9]+$"), b.try_cast("double"))
            try:
                literal = F.lit(float(wanted))
                on_histogram = F.exists(keys, lambda b: F.coalesce(COMPARISONS[op](number_of(b), literal), F.lit(False)))
            except ValueError:
                on_histogram = F.lit(False)
    else:
        field = get(["histograms", key, sub], "variant")
        on_histogram = null_test(field) if tests_null else _on_number(field, op, wanted)
    measure = get(["simpleMeasurements", key], "variant")
    about = get(["info", key], "variant")
    chosen = (
        F.when(hist.isNotNull(), on_histogram)
        .when(measure.isNotNull(), null_test(measure) if tests_null else _on_number(measure, op, wanted))
        .when(about.isNotNull(), null_test(about) if tests_null else _on_any(about, op, wanted))
    )
    return F.coalesce(chosen, F.lit(False))


def where_all(df: DataFrame, terms: Sequence[tuple]) -> DataFrame:
    """Keep documents for which every ``(key, sub, op, value)`` term holds."""
    return df.where(all_of([compares(key, op, value, sub) for key, sub, op, value in terms]))
