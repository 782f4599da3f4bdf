"""The scalar functions and the statement rows for users of SQL, as temporary functions of the session.

``register(spark)`` makes them. They are SQL expressions, so Spark inlines and optimizes them like any other; patterns
and tables come from :mod:`scalars`. ``slow_sql_entries`` gives an array; a generator takes its column, not the call, and
OUTER keeps the optimizer from making the array a second time to see whether it is empty::

    SELECT k, e.* FROM (SELECT k, slow_sql_entries(json) AS entries FROM submissions)
    LATERAL VIEW OUTER inline(entries) e WHERE e.thread IS NOT NULL
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from fieldlens.functions import scalars
from fieldlens.schema import DAY_LENGTH, MISSING, PART_TYPES, SALT_LENGTH, UUID_LENGTH


def _text(value: str) -> str:
    """A string literal whatever the value holds."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _first_match(value: str, pattern: str) -> str:
    found = f"regexp_extract({value}, {_text(pattern)}, 0)"
    return f"CASE WHEN {found} <> '' THEN {found} ELSE {value} END"


def _release(kernel: str) -> str:
    known = " ".join(f"WHEN startswith({kernel}, {_text(prefix)}) THEN {_text(release)}" for prefix, release in scalars.KERNEL_RELEASES)
    custom = " OR ".join(f"contains({kernel}, {_text(mark)})" for mark in scalars.CUSTOM_KERNEL_MARKS)
    return f"CASE {known} WHEN {custom} THEN {_text(scalars.CUSTOM_KERNEL_RELEASE)} WHEN {kernel} IS NOT NULL THEN concat('Unknown (', {kernel}, ')') END"


def _masked(sql: str, second: str) -> str:
    return f"regexp_replace(regexp_replace({sql}, {_text(scalars.SINGLE_QUOTED)}, '{scalars.LITERAL_MASK}'), {_text(second)}, '{scalars.LITERAL_MASK}')"


def _normalized(sql: str) -> str:
    escaped = f"replace({sql}, chr(1), {_text(chr(92) + 'u0001')})"
    white = r"[ \t\n\x0B\f\r]+"
    squeezed = f"regexp_replace({escaped}, {_text(white)}, ' ')"
    ends = r"^[\x00-\x20]+|[\x00-\x20]+$"
    return f"regexp_replace({squeezed}, {_text(ends)}, '')"


def _number(value: str) -> str:
    """A numeric leaf as a whole number; other leaves give NULL."""
    kind = f"schema_of_variant({value})"
    return (f"coalesce(CASE WHEN {kind} = 'BIGINT' THEN try_variant_get({value}, '$', 'bigint') END, CASE WHEN {kind} IN ('DOUBLE', 'FLOAT') "
            f"OR startswith({kind}, 'DECIMAL') THEN try_cast(try_variant_get({value}, '$', 'double') AS BIGINT) END)")


def _entries(json: str) -> str:
    """Statements of both threads; the arrays' numbers in order, other elements left out."""
    def of_thread(thread):
        pair = f"filter(transform(try_variant_get(e.value, '$', 'array<variant>'), x -> {_number('x')}), n -> n IS NOT NULL)"
        return (f"coalesce(transform(map_entries(slow.{thread}), e -> named_struct('thread', '{thread}', 'sql', {_normalized('e.key')}, 'pair', {pair})), "
                "CAST(array() AS ARRAY<STRUCT<thread: STRING, sql: STRING, pair: ARRAY<BIGINT>>>))")

    # The parsed part is bound by a transform over one element, so that it is parsed once.
    part = f"from_json(CASE WHEN startswith(ltrim({json}), '{{') THEN {json} END, 'slowSQL {PART_TYPES['slowSQL']}').slowSQL"
    every = f"concat({of_thread('mainThread')}, {of_thread('otherThreads')})"
    kept = f"transform(filter({every}, s -> s.pair IS NOT NULL), s -> named_struct('thread', s.thread, 'sql', s.sql, 'count', get(s.pair, 0), 't', get(s.pair, 1)))"
    return f"get(transform(array({part}), slow -> {kept}), 0)"


def definitions() -> dict[str, str]:
    """Signature and body of every function."""
    uptime = ("CASE WHEN m < 0 OR m >= 2880 THEN 2880 WHEN m >= 1440 THEN 1440 WHEN m >= 120 THEN m DIV 60 * 60 WHEN m >= 30 THEN m DIV 30 * 30 "
              "WHEN m >= 15 THEN 15 WHEN m >= 5 THEN 5 WHEN m IS NOT NULL THEN 0 END")
    grid = ("CASE WHEN t < 0 THEN -1 WHEN t >= low AND t < low + (high - low) DIV step * step + step THEN low + (t - low) DIV step * step "
            "WHEN t IS NOT NULL THEN 0 END")
    return {
        "salt_from_key(k STRING) RETURNS STRING": f"substring(k, 1, {SALT_LENGTH})",
        "day_from_key(k STRING) RETURNS STRING": f"substring(k, {1 + SALT_LENGTH}, {DAY_LENGTH})",
        "uuid_from_key(k STRING) RETURNS STRING": f"substring(k, {1 + SALT_LENGTH + DAY_LENGTH}, {UUID_LENGTH})",
        "null_default(v STRING) RETURNS STRING": f"coalesce(v, '{MISSING}')",
        "os_version(v STRING) RETURNS STRING": _first_match("v", scalars.OS_VERSION_PATTERN),
        "kernel_version(v STRING) RETURNS STRING": _first_match("v", scalars.KERNEL_VERSION_PATTERN),
        "kernel_release(v STRING) RETURNS STRING": _release("v"),
        "text_size(v STRING) RETURNS BIGINT": "CAST(length(v) AS BIGINT)",
        "uptime_bucket(m BIGINT) RETURNS BIGINT": uptime,
        "grid_bucket(t BIGINT, low BIGINT, high BIGINT, step BIGINT) RETURNS BIGINT": grid,
        "normalize_sql(s STRING) RETURNS STRING": _normalized("s"),
        "mask_literals(s STRING) RETURNS STRING": _masked("s", scalars.DOUBLE_QUOTED),
        "mask_literals_compat(s STRING) RETURNS STRING": _masked("s", scalars.MIXED_QUOTED),
        "time_ratio(a DOUBLE, b DOUBLE) RETURNS DOUBLE": "try_divide(a, b)",
        "slow_sql_entries(json STRING) RETURNS ARRAY<STRUCT<thread: STRING, sql: STRING, count: BIGINT, t: BIGINT>>": _entries("json"),
    }


def register(spark: SparkSession) -> list[str]:
    """Make the functions in this session, over any of the same names; returns their names."""
    made = []
    for signature, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        made.append(signature.split("(")[0])
    return made
