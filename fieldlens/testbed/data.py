"""Submissions, specifications and symbols derived from the given tables.

The tables hold no submission documents, so each event becomes one: its columns decide every field
by plain arithmetic, and a share of the documents is damaged in a known way. The same answers can
then be computed straight from the columns, without going through JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.schema import SPEC_DDL, SYMBOL_DDL
from fieldlens.session import configure

DESKTOP, TOUCH, MAIL, MOBILE, OTHER = "Surf", "SurfTouch", "Post", "SurfMobile", "Other"
ALL_PRODUCTS = (DESKTOP, TOUCH, MAIL, MOBILE)
DATASETS = ("hangs", "flash-versions", "mobile-flash-versions", "shutdown-times", "slowsql-main", "slowsql-other")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EVENTS_PER_TASK = 50_000


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event columns under short names: e, u, n, x (value), kind, d.

    A document is some fifty times the size of its event, so events are spread by their number before any row
    grows: pieces of a file hold as many events as its row groups do, which may be millions for one task. Each
    core has a piece at least. All columns decide the piece, so that repeated or missing ids are spread too.
    """
    events = table(spark, sf_dir, "events")
    pieces = max(spark.sparkContext.defaultParallelism, -(-events.count() // EVENTS_PER_TASK))
    events = events.repartition(pieces, *events.columns)
    return events.selectExpr(
        "event_id as e", "user_id as u", "cast(regexp_extract(props, '([0-9]+)', 1) as int) as n",
        "value as x", "event_type as kind", "date_format(ts, 'yyyyMMdd') as d",
    )


INFO = f"""named_struct(
  'reason', element_at(array('idle-daily', 'saved-session', 'saved-session', 'test-ping'), cast(e % 4 + 1 as int)),
  'appName', element_at(array('{DESKTOP}', '{TOUCH}', '{MAIL}', '{MOBILE}', '{OTHER}'), cast(u % 5 + 1 as int)),
  'appVersion', element_at(array('16.0', '18.0.1', '21.0a1', null, '16.0', '18.0.1', '21.0a1', '9.0'), cast(u % 8 + 1 as int)),
  'appUpdateChannel', element_at(array('nightly', 'aurora', 'beta', 'release', 'release', null), cast(u % 6 + 1 as int)),
  'OS', element_at(array('WINNT', 'Linux', 'Darwin'), cast(u % 3 + 1 as int)),
  'version', case u % 3 when 0 then '6.1' when 2 then '12.2.0' else
     element_at(array('3.0.31-g1', '2.6.35.7', '3.0.15-Cyanogen', '3.4.0'), cast(u % 4 + 1 as int)) end,
  'arch', case when u % 29 = 28 then null when u % 2 = 0 then 'x86' else 'x86-64' end,
  'appBuildID', concat('201301', lpad(cast(u % 7 + 10 as string), 2, '0')),
  'platformBuildID', concat('201302', lpad(cast(u % 3 + 10 as string), 2, '0')),
  'flashVersion', case when u % 3 = 0 then concat('11.', u % 4) end,
  'hasARMv6', u % 2 = 0,
  'hasARMv7', case when u % 8 = 3 then null else u % 4 = 0 end,
  'cpucount', u % 4 + 1,
  'memsize', 1024 * (1 + u % 8),
  'locale', case when u % 2 = 0 then 'en-US' else 'de' end)"""

MEASURES = """concat(
  '{"uptime":', case when e % 41 = 0 then -1 else cast(floor(x * 10) as bigint) end,
  ',"firstPaint":', cast(floor(x * 100) as bigint),
  ',"startupInterrupted":', e % 2,
  ',"startupCrashDetectionEnd":', 29000 + e * 7 % 65000,
  ',"savedPings":', e % 60,
  ',"js":{"e4x":', e % 3, ',"setProto":', e % 2, '}',
  case when e % 3 = 0 then concat(',"shutdownDuration":', n * 100) else '' end,
  case when e % 53 = 5 then ',"sessionRestored":"bad"' else concat(',"sessionRestored":', n * 350) end, '}')"""

HISTOGRAMS = """concat(
  '{"PAUSE_MS":{"range":', if(e % 50 = 5, '[1]', '[1,100]'), ',"bucket_count":', if(e % 50 = 8, 13, 12),
  ',"histogram_type":0',
  if(e % 50 = 6, '', concat(',"values":{"', n - n % 10, '":', 1 + e % 3, ',"100":', e % 2 * 2,
     if(e % 50 = 2, ',"abc":1', ''), '}')),
  case e % 50 when 1 then '' when 7 then ',"sum":"x"' else concat(',"sum":', n * (1 + e % 3)) end,
  case e % 50 when 3 then ',"valid":"false"' when 4 then ',"valid":"TRUE"' else '' end,
  '},"CYCLE_MS":{"range":[1,7],"bucket_count":8,"histogram_type":1,"values":{"', n % 7, '":1,"7":', e % 2,
  '},"sum":', n % 7,
  '},"USED_FLAG":{"range":[1,2],"bucket_count":3,"histogram_type":3,"values":{"0":', 1 - e % 2, ',"1":', e % 2,
  '},"sum":', e % 2, '}',
  if(e % 7 = 0, ',"OUT_OF_MEMORY_KILLED":{"range":[1,2],"bucket_count":3,"histogram_type":2,"values":{"0":0,"1":1},"sum":1}', ''),
  if(e % 5 = 0, concat(',"EXTRA_', u % 3, '":{"range":[1,10],"bucket_count":5,"histogram_type":1,"values":{"3":2},"sum":6}'), ''),
  '}')"""

SLOW_SQL = r"""concat(
  '{"mainThread":{',
  if(e % 2 = 0, concat('"SELECT  * FROM ', kind, ' WHERE n = ', n % 3, '":[', if(e % 43 = 0, 0, 1 + e % 3), ',',
     cast(floor(x) as bigint), ']',
     if(e % 6 = 0, concat(',"SELECT *\\tFROM ', kind, ' WHERE n = ', n % 3, ' ":[1,', cast(floor(x) as bigint) + 1, ']'), '')), ''),
  '},"otherThreads":{',
  if(e % 8 = 0, concat('"VACUUM":[1,', n, ']'), concat(
     '"UPDATE ', kind, " SET name = 'user", n % 10, "'", '":[', 1 + e % 3, ',', cast(floor(x) as bigint),
     '],"UPDATE ', kind, " SET name = 'admin'", '":[2,5]',
     if(e % 4 = 0, concat(',"DELETE FROM t WHERE a = \\"lit', n % 4, '\\"":[1,', n, ']'), ''))),
  '}}')"""

HANGS = """case
  when e % 20 = 10 then ',"chromeHangs":[]'
  when e % 20 = 15 then ',"chromeHangs":[{"stack":[[0,1]]}]'
  when e % 40 = 0 then ',"chromeHangs":{"memoryMap":[],"stacks":[],"durations":[]}'
  when e % 20 = 0 then concat(',"chromeHangs":{"memoryMap":',
     if(e % 3 = 0,
        concat('[["f0",10,"{d', u % 25, '-}","mod', u % 25, '"],["f1",10,"{d', (u + 7) % 25, '-}","mod', (u + 7) % 25, '"]]'),
        concat('[["mod', u % 25, '","D', u % 25, 'A"],["mod', (u + 7) % 25, '","D', (u + 7) % 25, 'A"]]')),
     ',"stacks":[[[0,', e * 31 % 12000, '],[1,', e * 17 % 12000, '],[-1,', e % 1000, ']]',
     if(e % 3 = 1, concat(',[[0,', e * 17 % 12000, ']]'), ''), '],"durations":[12]}')
  else '' end"""

LATE_WRITES = """if(e % 30 = 0, concat(',"lateWrites":{"memoryMap":[["mod', u % 25, '","D', u % 25, 'A"]],"stacks":[[[0,',
  e * 31 % 12000, '],[0,', e % 1000, ']]]}'), '')"""

KEY = """concat(chr(97 + e % 16), d, lower(hex(225 + e % 16)), substr(md5(cast(e as string)), 3, 6), '-',
  substr(md5(cast(e as string)), 9, 4), '-', substr(md5(cast(e as string)), 13, 4), '-',
  substr(md5(cast(e as string)), 17, 4), '-', substr(md5(cast(e as string)), 21, 12))"""


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One submission ``(k, d, json)`` per event."""
    configure(spark)
    text = f"""concat('{{"ver":1',
      if(e % 61 = 7, '', concat(',"info":', to_json({INFO}))),
      ',"simpleMeasurements":', if(e % 71 = 11, '"none"', {MEASURES}),
      if(e % 67 = 9, '', concat(',"histograms":', {HISTOGRAMS})),
      if(e % 9 = 8, '', concat(',"slowSQL":', {SLOW_SQL})),
      {HANGS}, {LATE_WRITES}, '}}')"""
    whole = facts(spark, sf_dir).selectExpr(f"{KEY} as k", "d", "e", f"{text} as text")
    return whole.selectExpr(
        "k", "d",
        "case when e % 101 = 7 then null when e % 97 = 13 then substr(text, 1, length(text) - 1) else text end as json",
    )


def specification(spark: SparkSession) -> DataFrame:
    """Four versions of a small specification; it only ever meets data derived from the tables."""
    tens = list(range(0, 101, 10))
    cycle = list(range(0, 8))
    rows = []
    for version, pause_edges, cycle_max in (
        ("default", tens, "7"), ("1", None, "9"), ("16", tens, "7"), ("18", [t for t in tens if t != 90], "7"),
    ):
        rows.append((version, "PAUSE_MS", "1", "100", "0", "12", pause_edges))
        rows.append((version, "CYCLE_MS", "1", cycle_max, "1", "8", cycle))
        rows.append((version, "USED_FLAG", "1", "2", "3", "3", [0, 1, 2]))
    rows.append(("default", "OUT_OF_MEMORY_KILLED", "1", "2", "2", "3", [0, 1, 2]))
    return spark.createDataFrame(rows, SPEC_DDL)


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A symbol table from ``part``: 25 modules with symbols at scattered offsets."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat('mod', p_partkey % 25) as module", "concat('D', p_partkey % 25, 'A') as debug_id",
        "p_partkey * 37 % 10007 as start", "concat(p_name, '_', p_partkey) as name",
    ).to(spark.createDataFrame([], SYMBOL_DDL).schema)


# Extracts: the delimited inputs of the statistics jobs

def cycle_collector_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).selectExpr(
        "cast(u as string) as id", "d as date_str", "'16.0' as version",
        "element_at(array('WINNT', 'Linux', 'Darwin'), cast(u % 3 + 1 as int)) as os", "'CYCLE_MS' as hist_name",
        "if(e % 37 = 3, 'bad', cast(n as string)) as hist_value", "cast(1 + e % 3 as string) as hist_value_count",
        "cast(n * (1 + e % 3) as string) as hist_sum",
    )


def gc_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).selectExpr(
        "cast(e as string) as key", "d as date_str",
        "element_at(array('16.0', '18.0.1', '21.0a1'), cast(u % 3 + 1 as int)) as version",
        "cast(n as double) as sum_count", "floor(x) * 1.0d as uptime",
    )


def slow_sql_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).selectExpr(
        "concat('SELECT * FROM ', kind, ' WHERE n = ', n % 10) as sql", "cast(e % 5 as string) as count",
        "cast(cast(floor(x) as bigint) as string) as time",
    )


def first_paint_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "if(l_linenumber <= 4, '10.0a1', '9.0') as version", "if(l_returnflag = 'N', 'WINNT', 'Linux') as os",
        "if(l_linestatus = 'O', '6.1', '5.1') as osversion", "l_orderkey % 2 as si",
        "case when l_partkey % 31 = 0 then null else cast(floor(l_extendedprice) as bigint) - 1500 end as firstpaint",
        "case when l_suppkey % 17 = 0 then null else cast(floor(l_extendedprice / 3) as bigint) + l_linenumber * 500 end as sessionrestored",
        "case when l_partkey % 7 = 0 then null else cast(l_quantity as bigint) end as places",
        "cast(floor(l_extendedprice / 2) as bigint) as ndco",
    )
