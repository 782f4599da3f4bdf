"""Scalar functions, all built from Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlens.schema import FINGERPRINT_FIELDS, MISSING, SALT_LENGTH, DAY_LENGTH, UUID_LENGTH

# Version patterns, one or up to two dotted parts.
OS_VERSION_PATTERN = r"^[0-9](\.*[0-9]*){1}"
KERNEL_VERSION_PATTERN = r"^[0-9](\.*[0-9]*){1,2}"

# Kernel version prefix -> platform release, first match counts.
KERNEL_RELEASES = [
    ("2.6.27", "1.5"),
    ("2.6.29", "1.6/2.0.x/2.1"),
    ("2.6.32", "2.2.x"),
    ("2.6.35", "2.3.x"),
    ("2.6.36", "3.x"),
    ("2.6.39.4", "4.0.x"),
    ("3.0.1", "4.0.x"),
    ("3.0.8", "4.0.x"),
    ("3.0.31", "4.1.x"),
    ("3.1.10", "4.1.x"),
]
CUSTOM_KERNEL_MARKS = ("Cyanogen", "cyanogen")
CUSTOM_KERNEL_RELEASE = "CyanogenMod"

# Literal patterns and what replaces a literal.
SINGLE_QUOTED = r"'[^'\\]*(?:\\.[^'\\]*)*'"
DOUBLE_QUOTED = r'"[^"\\]*(?:\\.[^"\\]*)*"'
MIXED_QUOTED = r"""'[^"\\]*(?:\\.[^"\\]*)*\""""
LITERAL_MASK = ":private"


# Row keys

def salt_from_key(k: Column) -> Column:
    return F.substring(k, 1, SALT_LENGTH)


def day_from_key(k: Column) -> Column:
    return F.substring(k, 1 + SALT_LENGTH, DAY_LENGTH)


def uuid_from_key(k: Column) -> Column:
    return F.substring(k, 1 + SALT_LENGTH + DAY_LENGTH, UUID_LENGTH)


def salt_matches(k: Column) -> Column:
    """The salt character's code is the first UUID byte less 128, modulo 256."""
    first_byte = F.conv(F.substring(uuid_from_key(k), 1, 2), 16, 10).cast("int")
    return F.coalesce(F.ascii(salt_from_key(k)) == F.pmod(first_byte - 128, F.lit(256)), F.lit(False))


# Text

def null_default(value: Column, default: str = MISSING) -> Column:
    return F.coalesce(value, F.lit(default))


def find_or_return(value: Column, pattern: str) -> Column:
    """First match of the pattern, or the text itself when there is none."""
    found = F.regexp_extract(value, pattern, 0)
    return F.when(found != "", found).otherwise(value)


def os_version(value: Column) -> Column:
    return find_or_return(value, OS_VERSION_PATTERN)


def kernel_version(value: Column) -> Column:
    return find_or_return(value, KERNEL_VERSION_PATTERN)


def kernel_release(kernel: Column) -> Column:
    """Platform release that shipped a kernel version."""
    out = None
    for prefix, release in KERNEL_RELEASES:
        condition = kernel.startswith(prefix)
        out = F.when(condition, release) if out is None else out.when(condition, release)
    custom = F.lit(False)
    for mark in CUSTOM_KERNEL_MARKS:
        custom = custom | kernel.contains(mark)
    return out.when(custom, CUSTOM_KERNEL_RELEASE).when(
        kernel.isNotNull(), F.concat(F.lit("Unknown ("), kernel, F.lit(")"))
    )


def normalize_sql(sql: Column) -> Column:
    """Escape the report separator, squeeze white space, cut control characters at both ends."""
    escaped = F.replace(sql, F.lit("\x01"), F.lit("\\u0001"))
    squeezed = F.regexp_replace(escaped, r"[ \t\n\x0B\f\r]+", " ")
    return F.regexp_replace(squeezed, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def mask_literals(sql: Column, compat: bool = False) -> Column:
    """Replace quoted literals; ``compat`` keeps the historic pattern that misses double-quoted ones."""
    masked = F.regexp_replace(sql, SINGLE_QUOTED, LITERAL_MASK)
    return F.regexp_replace(masked, MIXED_QUOTED if compat else DOUBLE_QUOTED, LITERAL_MASK)


def fingerprint(field_of, fields=FINGERPRINT_FIELDS) -> Column:
    """MD5 over the listed fields; ``field_of(name)`` gives each as text.

    Absent and empty fields differ, and a separator keeps neighbours apart.
    """
    parts = [F.coalesce(F.concat(F.lit("="), field_of(name)), F.lit("")) for name in fields]
    return F.md5(F.concat_ws("\x1f", *parts))


def text_size(text: Column, in_bytes: bool = False) -> Column:
    return (F.octet_length(text) if in_bytes else F.length(text)).cast("bigint")


# Numbers and buckets

def uptime_bucket(minutes: Column) -> Column:
    """Lower edge of the uptime bucket: 0, 5, 15, then steps of 30 to 120 and of 60 to 1440.

    The last bucket, 2880, also takes negative uptimes.
    """
    def on_grid(step):
        return F.floor(minutes / step).cast("bigint") * step

    return (
        F.when((minutes < 0) | (minutes >= 2880), F.lit(2880))
        .when(minutes >= 1440, F.lit(1440))
        .when(minutes >= 120, on_grid(60))
        .when(minutes >= 30, on_grid(30))
        .when(minutes >= 15, F.lit(15))
        .when(minutes >= 5, F.lit(5))
        .when(minutes.isNotNull(), F.lit(0))
    ).cast("bigint")


def grid_bucket(t: Column, low: int, high: int, step: int, default: int = 0) -> Column:
    """Lower edge of ``[edge, edge + step)`` for edges from ``low`` to at most ``high``.

    Below zero gives -1, outside the grid the default.
    """
    if step < 1:
        raise ValueError("step must be at least 1")
    last_edge = low + (high - low) // step * step
    edge = F.lit(low) + F.floor((t - low) / step).cast("bigint") * step
    return (
        F.when(t < 0, F.lit(-1))
        .when((t >= low) & (t < last_edge + step), edge)
        .when(t.isNotNull(), F.lit(default))
    ).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero divisor gives NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def day_to_date(day: Column) -> Column:
    return F.try_to_date(day, "yyyyMMdd")


def major_version(version: Column) -> Column:
    return F.split_part(version, F.lit("."), F.lit(1)).try_cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.when(condition, 1).otherwise(0)


def clamp_low_high(value: Column, limit: float, above: float, low: float = -1) -> Column:
    """Missing and negative values to ``low``, values over ``limit`` to ``above``."""
    return (
        F.when(value.isNull() | F.isnan(value.cast("double")) | (value < 0), F.lit(low))
        .when(value > limit, F.lit(above))
        .otherwise(value)
    )


def cap(value: Column, limit: float, above: float) -> Column:
    return F.when(value > limit, F.lit(above)).otherwise(value)


def right_closed_bin(value: Column, origin: float, width: float) -> Column:
    """Upper edge of the bin ``(edge - width, edge]`` on a grid from ``origin``."""
    return F.lit(origin) + F.ceil((value - origin) / width) * width


def in_sample(key: Column, rate: float, salt: str = "") -> Column:
    """Repeatable Bernoulli choice by 60 bits of a hash of the key; samples of other salts are independent."""
    share = F.conv(F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 15), 16, 10).cast("bigint")
    return share < int(rate * 2**60)
