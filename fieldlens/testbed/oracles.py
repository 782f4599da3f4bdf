"""The same answers as SQL over the tables.

Nothing here goes through JSON: each answer is computed from the columns the documents were made of,
so parsing, expansion and rewriting are checked by another route.

Averages are rounded on both sides after adding 1e-9: a value that lies on a rounding border would
otherwise fall to either side with the order in which its terms were added.
"""

from __future__ import annotations

from fieldlens.testbed.data import ALL_PRODUCTS, DESKTOP, MAIL, MOBILE, OTHER, TOUCH

ORACLES: dict[str, str] = {}

# One row per event with the facts that decide its document.
FACTS = f"""
facts AS (
  SELECT event_id AS e, user_id AS u, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS n, value AS x,
         event_type AS kind, strftime(ts, '%Y%m%d') AS d, md5(CAST(event_id AS VARCHAR)) AS h
  FROM events),
base AS (
  SELECT *, chr(CAST(97 + e % 16 AS INTEGER)) || d || lower(to_hex(225 + e % 16)) || substr(h, 3, 6) || '-' || substr(h, 9, 4)
           || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS k,
         e % 101 = 7 AS null_json, e % 101 <> 7 AND e % 97 = 13 AS bad_json, e % 101 <> 7 AND e % 97 <> 13 AS ok
  FROM facts),
docs AS (
  SELECT *, ok AND e % 61 <> 7 AS has_info, ok AND e % 67 <> 9 AS has_hist, ok AND e % 71 <> 11 AS has_measures,
         ok AND e % 9 <> 8 AS has_slow FROM base),
info AS (
  SELECT *,
    CASE WHEN has_info THEN CASE e % 4 WHEN 0 THEN 'idle-daily' WHEN 3 THEN 'test-ping' ELSE 'saved-session' END END AS reason,
    CASE WHEN has_info THEN CASE u % 5 WHEN 0 THEN '{DESKTOP}' WHEN 1 THEN '{TOUCH}' WHEN 2 THEN '{MAIL}' WHEN 3 THEN '{MOBILE}' ELSE '{OTHER}' END END AS product,
    CASE WHEN has_info THEN CASE u % 8 WHEN 0 THEN '16.0' WHEN 4 THEN '16.0' WHEN 1 THEN '18.0.1' WHEN 5 THEN '18.0.1'
      WHEN 2 THEN '21.0a1' WHEN 6 THEN '21.0a1' WHEN 7 THEN '9.0' END END AS version,
    CASE WHEN has_info THEN CASE u % 6 WHEN 0 THEN 'nightly' WHEN 1 THEN 'aurora' WHEN 2 THEN 'beta' WHEN 3 THEN 'release' WHEN 4 THEN 'release' END END AS channel,
    CASE WHEN has_info THEN CASE u % 3 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Linux' ELSE 'Darwin' END END AS os,
    CASE WHEN has_info THEN CASE u % 3 WHEN 0 THEN '6.1' WHEN 2 THEN '12.2.0' ELSE
      CASE u % 4 WHEN 0 THEN '3.0.31-g1' WHEN 1 THEN '2.6.35.7' WHEN 2 THEN '3.0.15-Cyanogen' ELSE '3.4.0' END END END AS kernel,
    CASE WHEN has_info AND u % 29 <> 28 THEN CASE u % 2 WHEN 0 THEN 'x86' ELSE 'x86-64' END END AS arch,
    CASE WHEN has_info THEN '201301' || CAST(u % 7 + 10 AS VARCHAR) END AS build,
    CASE WHEN has_info THEN '201302' || CAST(u % 3 + 10 AS VARCHAR) END AS plat_build,
    CASE WHEN has_info AND u % 3 = 0 THEN '11.' || CAST(u % 4 AS VARCHAR) END AS flash,
    CASE WHEN has_info THEN u % 2 = 0 END AS armv6,
    CASE WHEN has_info AND u % 8 <> 3 THEN u % 4 = 0 END AS armv7
  FROM docs),
subs AS (
  SELECT *, coalesce(channel, 'NA') AS channel_na,
    CASE kernel WHEN '6.1' THEN '6.1' WHEN '12.2.0' THEN '12' WHEN '3.0.31-g1' THEN '3.0' WHEN '2.6.35.7' THEN '2.6'
      WHEN '3.0.15-Cyanogen' THEN '3.0' WHEN '3.4.0' THEN '3.4' END AS os_version,
    CASE kernel WHEN '6.1' THEN '6.1' WHEN '12.2.0' THEN '12.2' WHEN '3.0.31-g1' THEN '3.0.31' WHEN '2.6.35.7' THEN '2.6.35'
      WHEN '3.0.15-Cyanogen' THEN '3.0.15' WHEN '3.4.0' THEN '3.4.0' END AS kernel_cut,
    CASE kernel WHEN '6.1' THEN 'Unknown (6.1)' WHEN '12.2.0' THEN 'Unknown (12.2.0)' WHEN '3.0.31-g1' THEN '4.1.x'
      WHEN '2.6.35.7' THEN '2.3.x' WHEN '3.0.15-Cyanogen' THEN '4.0.x' WHEN '3.4.0' THEN 'Unknown (3.4.0)' END AS android
  FROM info)"""

PRODUCTS = ", ".join(f"'{p}'" for p in ALL_PRODUCTS)
COMPLETE = "has_info AND has_hist AND has_measures AND reason IN ('idle-daily', 'saved-session')"

UPTIME_EDGES = "[0, 5, 15, 30, 60, 90, 120, " + ", ".join(str(t) for t in range(180, 1441, 60)) + "]"


def uptime(value: str) -> str:
    return (f"CASE WHEN {value} < 0 OR {value} >= 2880 THEN 2880 "
            f"ELSE list_max(list_filter({UPTIME_EDGES}, lambda edge: edge <= {value})) END")


def grid(value: str, low: int, last: int, step: int) -> str:
    return (f"CASE WHEN {value} < 0 THEN -1 WHEN {value} >= {low} AND {value} < {last + step} "
            f"THEN {low} + ({value} - {low}) // {step} * {step} ELSE 0 END")


def hist(name: str, where: str, total: str, bucket_count: str, low: str, high: str, kind: int, valid: str,
         buckets: list[tuple[str, str]]) -> str:
    pairs = ", ".join(f"{{'v': CAST({v} AS BIGINT), 'count': CAST({c} AS DOUBLE)}}" for v, c in buckets)
    return f"""SELECT *, {name} AS hist_name, CAST({total} AS BIGINT) AS sum, {bucket_count} AS bucket_count,
      {low} AS min_range, {high} AS max_range, {kind} AS hist_type, {valid} AS is_valid, [{pairs}] AS buckets
      FROM kept WHERE {where}"""


HISTOGRAMS = " UNION ALL ".join([
    hist("'PAUSE_MS'", "has_hist AND e % 50 NOT IN (1, 6, 7)", "n * (1 + e % 3)", "CASE WHEN e % 50 = 8 THEN 13 ELSE 12 END",
         "CASE WHEN e % 50 = 5 THEN 0 ELSE 1 END", "CASE WHEN e % 50 = 5 THEN 0 ELSE 100 END", 0,
         "CASE WHEN e % 50 = 3 THEN 0 ELSE 1 END", [("n - n % 10", "1 + e % 3"), ("100", "e % 2 * 2")]),
    hist("'CYCLE_MS'", "has_hist", "n % 7", "8", "1", "7", 1, "1", [("n % 7", "1"), ("7", "e % 2")]),
    hist("'USED_FLAG'", "has_hist", "e % 2", "3", "1", "2", 3, "1", [("0", "1 - e % 2"), ("1", "e % 2")]),
    hist("'OUT_OF_MEMORY_KILLED'", "has_hist AND e % 7 = 0", "1", "3", "1", "2", 2, "1", [("0", "0"), ("1", "1")]),
    hist("'EXTRA_' || CAST(u % 3 AS VARCHAR)", "has_hist AND e % 5 = 0", "6", "5", "1", "10", 1, "1", [("3", "2")]),
])


def measure(name: str, value: str, bucket: str, layout: tuple[int, int, int, int], where: str = "true") -> str:
    count, low, high, kind = layout
    return hist(f"'SIMPLE_MEASURES_{name}'", f"has_measures AND {where}", value, str(count), str(low), str(high), kind, "1",
                [(bucket, "1")])


FLAG, OTHER_LAYOUT = (2, 0, 1, 2), (31, 0, 30001, 1)
UPTIME_VALUE = "CASE WHEN e % 41 = 0 THEN -1 ELSE CAST(floor(x * 10) AS BIGINT) END"
PAINT = "CAST(floor(x * 100) AS BIGINT)"
MEASURES = " UNION ALL ".join([
    measure("UPTIME", UPTIME_VALUE, uptime(f"({UPTIME_VALUE})"), (30, 0, 2880, 0)),
    measure("FIRSTPAINT", PAINT, grid(PAINT, 0, 30000, 1000), OTHER_LAYOUT),
    measure("STARTUPINTERRUPTED", "e % 2", "e % 2", FLAG),
    measure("STARTUPCRASHDETECTIONEND", "29000 + e * 7 % 65000", grid("(29000 + e * 7 % 65000)", 30000, 90000, 2000),
            (30, 30000, 90000, 1)),
    measure("SAVEDPINGS", "e % 60", grid("(e % 60)", 0, 50, 1), (51, 0, 50, 0)),
    measure("JS_E4X", "e % 3", "e % 3", FLAG),
    measure("JS_SETPROTO", "e % 2", "e % 2", FLAG),
    measure("SHUTDOWNDURATION", "n * 100", grid("(n * 100)", 0, 30000, 1000), OTHER_LAYOUT, "e % 3 = 0"),
    measure("SESSIONRESTORED", "n * 350", grid("(n * 350)", 0, 30000, 1000), OTHER_LAYOUT, "e % 53 <> 5"),
])

KEPT = f"kept AS (SELECT * FROM subs WHERE {COMPLETE} AND product IN ({PRODUCTS}))"
ENTRIES = f"entries AS ({HISTOGRAMS} UNION ALL {MEASURES})"
POINTS = """points AS (SELECT * EXCLUDE (buckets, b), b.v AS v, b.count AS count FROM (SELECT *, unnest(buckets) AS b FROM entries))"""
DIMS = """d, reason, product, version AS product_version, channel_na AS product_channel, arch, os, os_version,
  build AS app_build_id, plat_build AS plat_build_id"""
DIM_NAMES = "d, reason, product, product_version, product_channel, arch, os, os_version, app_build_id, plat_build_id"
NAME_KEYS = DIM_NAMES + ", is_valid, hist_name"
NAME_TOTALS = f"""name_totals AS (SELECT {DIMS}, is_valid, hist_name, CAST(sum(sum) AS BIGINT) AS sum_sum, count(*) AS doc_count
  FROM entries GROUP BY ALL)"""
VALUE_TOTALS = f"""value_totals AS (SELECT {DIMS}, is_valid, hist_name, v, max(bucket_count) AS bucket_count,
  CAST(min(min_range) AS BIGINT) AS min_range, CAST(max(max_range) AS BIGINT) AS max_range, max(hist_type) AS hist_type,
  sum(count) AS sum_count FROM points GROUP BY ALL)"""
JOINED = f"""joined AS (SELECT v.*, n.sum_sum AS hist_name_sum, n.doc_count AS hist_name_doc_count
  FROM value_totals v JOIN name_totals n USING ({NAME_KEYS}))"""

MAIN_1 = """SELECT *, 'mainThread' AS thread, 'SELECT * FROM ' || kind || ' WHERE n = ' || CAST(n % 3 AS VARCHAR) AS sql,
  CASE WHEN e % 43 = 0 THEN 0 ELSE 1 + e % 3 END AS count, CAST(floor(x) AS BIGINT) AS t FROM subs WHERE has_slow AND e % 2 = 0"""
MAIN_2 = """SELECT *, 'mainThread' AS thread, 'SELECT * FROM ' || kind || ' WHERE n = ' || CAST(n % 3 AS VARCHAR) AS sql,
  1 AS count, CAST(floor(x) AS BIGINT) + 1 AS t FROM subs WHERE has_slow AND e % 6 = 0"""
VACUUM = "SELECT *, 'otherThreads' AS thread, 'VACUUM' AS sql, 1 AS count, n AS t FROM subs WHERE has_slow AND e % 8 = 0"
OTHER_1 = """SELECT *, 'otherThreads' AS thread, 'UPDATE ' || kind || ' SET name = ''user' || CAST(n % 10 AS VARCHAR) || '''' AS sql,
  1 + e % 3 AS count, CAST(floor(x) AS BIGINT) AS t FROM subs WHERE has_slow AND e % 8 <> 0"""
OTHER_2 = """SELECT *, 'otherThreads' AS thread, 'UPDATE ' || kind || ' SET name = ''admin''' AS sql, 2 AS count, 5 AS t
  FROM subs WHERE has_slow AND e % 8 <> 0"""
OTHER_3 = """SELECT *, 'otherThreads' AS thread, 'DELETE FROM t WHERE a = "lit' || CAST(n % 4 AS VARCHAR) || '"' AS sql, 1 AS count, n AS t
  FROM subs WHERE has_slow AND e % 8 <> 0 AND e % 4 = 0"""
MASKED_1 = """SELECT *, 'otherThreads' AS thread, 'UPDATE ' || kind || ' SET name = :private' AS sql,
  3 + e % 3 AS count, CAST(floor(x) AS BIGINT) + 5 AS t FROM subs WHERE has_slow AND e % 8 <> 0"""
MASKED_3 = """SELECT *, 'otherThreads' AS thread, 'DELETE FROM t WHERE a = :private' AS sql, 1 AS count, n AS t
  FROM subs WHERE has_slow AND e % 8 <> 0 AND e % 4 = 0"""


def statements(*parts: str) -> str:
    return f"statements AS ({' UNION ALL '.join(parts)})"


SLOW = statements(MAIN_1, MAIN_2, VACUUM, OTHER_1, OTHER_2, OTHER_3)
SLOW_MASKED = statements(MAIN_1, MAIN_2, VACUUM, MASKED_1, MASKED_3)


def oracle(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",\n".join([FACTS, *ctes]) + "\n" + select


def plain(name: str, select: str) -> None:
    ORACLES[name] = select


# Documents, for the few answers that need their text: the text itself, put together by concatenation.
TEXT = f"""
texts AS (
  SELECT k, d, e, u, null_json, bad_json, '{{"ver":1' ||
    CASE WHEN e % 61 = 7 THEN '' ELSE ',"info":{{"reason":"' || CASE e % 4 WHEN 0 THEN 'idle-daily' WHEN 3 THEN 'test-ping' ELSE 'saved-session' END
      || '","appName":"' || CASE u % 5 WHEN 0 THEN '{DESKTOP}' WHEN 1 THEN '{TOUCH}' WHEN 2 THEN '{MAIL}' WHEN 3 THEN '{MOBILE}' ELSE '{OTHER}' END || '"'
      || CASE WHEN u % 8 = 3 THEN '' ELSE ',"appVersion":"' || CASE u % 8 WHEN 0 THEN '16.0' WHEN 4 THEN '16.0' WHEN 1 THEN '18.0.1' WHEN 5 THEN '18.0.1' WHEN 7 THEN '9.0' ELSE '21.0a1' END || '"' END
      || CASE WHEN u % 6 = 5 THEN '' ELSE ',"appUpdateChannel":"' || CASE u % 6 WHEN 0 THEN 'nightly' WHEN 1 THEN 'aurora' WHEN 2 THEN 'beta' ELSE 'release' END || '"' END
      || ',"OS":"' || CASE u % 3 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Linux' ELSE 'Darwin' END || '","version":"'
      || CASE u % 3 WHEN 0 THEN '6.1' WHEN 2 THEN '12.2.0' ELSE CASE u % 4 WHEN 0 THEN '3.0.31-g1' WHEN 1 THEN '2.6.35.7' WHEN 2 THEN '3.0.15-Cyanogen' ELSE '3.4.0' END END || '"'
      || CASE WHEN u % 29 = 28 THEN '' ELSE ',"arch":"' || CASE u % 2 WHEN 0 THEN 'x86' ELSE 'x86-64' END || '"' END
      || ',"appBuildID":"201301' || CAST(u % 7 + 10 AS VARCHAR) || '","platformBuildID":"201302' || CAST(u % 3 + 10 AS VARCHAR) || '"'
      || CASE WHEN u % 3 = 0 THEN ',"flashVersion":"11.' || CAST(u % 4 AS VARCHAR) || '"' ELSE '' END
      || ',"hasARMv6":' || CASE WHEN u % 2 = 0 THEN 'true' ELSE 'false' END
      || CASE WHEN u % 8 = 3 THEN '' ELSE ',"hasARMv7":' || CASE WHEN u % 4 = 0 THEN 'true' ELSE 'false' END END
      || ',"cpucount":' || CAST(u % 4 + 1 AS VARCHAR) || ',"memsize":' || CAST(1024 * (1 + u % 8) AS VARCHAR)
      || ',"locale":"' || CASE WHEN u % 2 = 0 THEN 'en-US' ELSE 'de' END || '"}}' END
    || ',"simpleMeasurements":' || CASE WHEN e % 71 = 11 THEN '"none"' ELSE
      '{{"uptime":' || CAST({UPTIME_VALUE} AS VARCHAR) || ',"firstPaint":' || CAST({PAINT} AS VARCHAR)
      || ',"startupInterrupted":' || CAST(e % 2 AS VARCHAR) || ',"startupCrashDetectionEnd":' || CAST(29000 + e * 7 % 65000 AS VARCHAR)
      || ',"savedPings":' || CAST(e % 60 AS VARCHAR) || ',"js":{{"e4x":' || CAST(e % 3 AS VARCHAR) || ',"setProto":' || CAST(e % 2 AS VARCHAR) || '}}'
      || CASE WHEN e % 3 = 0 THEN ',"shutdownDuration":' || CAST(n * 100 AS VARCHAR) ELSE '' END
      || ',"sessionRestored":' || CASE WHEN e % 53 = 5 THEN '"bad"' ELSE CAST(n * 350 AS VARCHAR) END || '}}' END
    || CASE WHEN e % 67 = 9 THEN '' ELSE ',"histograms":{{"PAUSE_MS":{{"range":' || CASE WHEN e % 50 = 5 THEN '[1]' ELSE '[1,100]' END
      || ',"bucket_count":' || CASE WHEN e % 50 = 8 THEN '13' ELSE '12' END || ',"histogram_type":0'
      || CASE WHEN e % 50 = 6 THEN '' ELSE ',"values":{{"' || CAST(n - n % 10 AS VARCHAR) || '":' || CAST(1 + e % 3 AS VARCHAR)
         || ',"100":' || CAST(e % 2 * 2 AS VARCHAR) || CASE WHEN e % 50 = 2 THEN ',"abc":1' ELSE '' END || '}}' END
      || CASE e % 50 WHEN 1 THEN '' WHEN 7 THEN ',"sum":"x"' ELSE ',"sum":' || CAST(n * (1 + e % 3) AS VARCHAR) END
      || CASE e % 50 WHEN 3 THEN ',"valid":"false"' WHEN 4 THEN ',"valid":"TRUE"' ELSE '' END
      || '}},"CYCLE_MS":{{"range":[1,7],"bucket_count":8,"histogram_type":1,"values":{{"' || CAST(n % 7 AS VARCHAR) || '":1,"7":' || CAST(e % 2 AS VARCHAR)
      || '}},"sum":' || CAST(n % 7 AS VARCHAR) || '}},"USED_FLAG":{{"range":[1,2],"bucket_count":3,"histogram_type":3,"values":{{"0":'
      || CAST(1 - e % 2 AS VARCHAR) || ',"1":' || CAST(e % 2 AS VARCHAR) || '}},"sum":' || CAST(e % 2 AS VARCHAR) || '}}'
      || CASE WHEN e % 7 = 0 THEN ',"OUT_OF_MEMORY_KILLED":{{"range":[1,2],"bucket_count":3,"histogram_type":2,"values":{{"0":0,"1":1}},"sum":1}}' ELSE '' END
      || CASE WHEN e % 5 = 0 THEN ',"EXTRA_' || CAST(u % 3 AS VARCHAR) || '":{{"range":[1,10],"bucket_count":5,"histogram_type":1,"values":{{"3":2}},"sum":6}}' ELSE '' END
      || '}}' END
    || CASE WHEN e % 9 = 8 THEN '' ELSE ',"slowSQL":{{"mainThread":{{'
      || CASE WHEN e % 2 = 0 THEN '"SELECT  * FROM ' || kind || ' WHERE n = ' || CAST(n % 3 AS VARCHAR) || '":['
         || CASE WHEN e % 43 = 0 THEN '0' ELSE CAST(1 + e % 3 AS VARCHAR) END || ',' || CAST(CAST(floor(x) AS BIGINT) AS VARCHAR) || ']'
         || CASE WHEN e % 6 = 0 THEN ',"SELECT *\\tFROM ' || kind || ' WHERE n = ' || CAST(n % 3 AS VARCHAR) || ' ":[1,' || CAST(CAST(floor(x) AS BIGINT) + 1 AS VARCHAR) || ']' ELSE '' END ELSE '' END
      || '}},"otherThreads":{{' || CASE WHEN e % 8 = 0 THEN '"VACUUM":[1,' || CAST(n AS VARCHAR) || ']' ELSE
         '"UPDATE ' || kind || ' SET name = ''user' || CAST(n % 10 AS VARCHAR) || '''":[' || CAST(1 + e % 3 AS VARCHAR) || ',' || CAST(CAST(floor(x) AS BIGINT) AS VARCHAR)
         || '],"UPDATE ' || kind || ' SET name = ''admin''":[2,5]'
         || CASE WHEN e % 4 = 0 THEN ',"DELETE FROM t WHERE a = \\"lit' || CAST(n % 4 AS VARCHAR) || '\\"":[1,' || CAST(n AS VARCHAR) || ']' ELSE '' END END || '}}}}' END
    || CASE WHEN e % 20 = 10 THEN ',"chromeHangs":[]' WHEN e % 20 = 15 THEN ',"chromeHangs":[{{"stack":[[0,1]]}}]'
      WHEN e % 40 = 0 THEN ',"chromeHangs":{{"memoryMap":[],"stacks":[],"durations":[]}}'
      WHEN e % 20 = 0 THEN ',"chromeHangs":{{"memoryMap":' || CASE WHEN e % 3 = 0 THEN
          '[["f0",10,"{{d' || CAST(u % 25 AS VARCHAR) || '-}}","mod' || CAST(u % 25 AS VARCHAR) || '"],["f1",10,"{{d' || CAST((u + 7) % 25 AS VARCHAR) || '-}}","mod' || CAST((u + 7) % 25 AS VARCHAR) || '"]]'
        ELSE '[["mod' || CAST(u % 25 AS VARCHAR) || '","D' || CAST(u % 25 AS VARCHAR) || 'A"],["mod' || CAST((u + 7) % 25 AS VARCHAR) || '","D' || CAST((u + 7) % 25 AS VARCHAR) || 'A"]]' END
        || ',"stacks":[[[0,' || CAST(e * 31 % 12000 AS VARCHAR) || '],[1,' || CAST(e * 17 % 12000 AS VARCHAR) || '],[-1,' || CAST(e % 1000 AS VARCHAR) || ']]'
        || CASE WHEN e % 3 = 1 THEN ',[[0,' || CAST(e * 17 % 12000 AS VARCHAR) || ']]' ELSE '' END || '],"durations":[12]}}'
      ELSE '' END
    || CASE WHEN e % 30 = 0 THEN ',"lateWrites":{{"memoryMap":[["mod' || CAST(u % 25 AS VARCHAR) || '","D' || CAST(u % 25 AS VARCHAR) || 'A"]],"stacks":[[[0,'
      || CAST(e * 31 % 12000 AS VARCHAR) || '],[0,' || CAST(e % 1000 AS VARCHAR) || ']]]}}' ELSE '' END
    || '}}' AS whole
  FROM base),
stored AS (SELECT k, d, e, CASE WHEN null_json THEN NULL WHEN bad_json THEN substr(whole, 1, length(whole) - 1) ELSE whole END AS json FROM texts)"""

# Sources and sinks
oracle("scan_date_range", "SELECT k, d, json FROM stored WHERE d BETWEEN '20240105' AND '20240112'", TEXT)
oracle("row_key_decode", "SELECT k, substr(k, 1, 1) AS salt, d, substr(k, 10) AS uuid, true AS salt_ok FROM base")
oracle("archive_roundtrip", "SELECT k, d, json FROM stored", TEXT)
oracle("store_roundtrip", """SELECT d, count(*) AS n, CAST(sum(length(json)) AS BIGINT) AS chars FROM stored
  WHERE d BETWEEN '20240105' AND '20240112' GROUP BY d""", TEXT)
oracle("upsert_overlay", """SELECT b.k, b.d, md5(CASE WHEN (225 + b.e % 16) % 3 = 0 THEN 'new:' || substr(b.k, 2, 8) ELSE t.json END) AS digest
  FROM base b JOIN stored t USING (k) WHERE (225 + b.e % 16) % 5 <> 0 OR (225 + b.e % 16) % 3 = 0""", TEXT)
oracle("import_archive", "SELECT k, d, md5(json) AS digest FROM stored", TEXT)
oracle("delimited_sink", """SELECT sink, d, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(k || '|' || d || '|' || uuid), 1, 12) AS BIGINT)) AS BIGINT) AS digest FROM (
  SELECT sink, k, d, substr(k, 10) AS uuid FROM base CROSS JOIN (VALUES ('comma'), ('control-a'), ('tab')) s(sink)
  UNION ALL SELECT 'single', CAST(count(*) AS VARCHAR), d, d FROM base GROUP BY d) GROUP BY sink, d""")
oracle("delimited_sink_digests", """SELECT sink, d, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(k || '|' || d || '|' || uuid), 1, 12) AS BIGINT)) AS VARCHAR) AS digest FROM (
  SELECT sink, k, d, substr(k, 10) AS uuid FROM base CROSS JOIN (VALUES ('comma'), ('control-a'), ('tab')) s(sink)
  UNION ALL SELECT 'single', CAST(count(*) AS VARCHAR), d, d FROM base GROUP BY d) GROUP BY sink, d""")
oracle("delimited_source", """SELECT CAST(u AS VARCHAR) AS id, d AS date_str,
  CASE u % 3 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Linux' ELSE 'Darwin' END AS os,
  CASE WHEN e % 37 = 3 THEN NULL ELSE CAST(n AS DOUBLE) END AS hist_value, CAST(1 + e % 3 AS DOUBLE) AS hist_value_count FROM facts""")
oracle("key_json_lines", "SELECT k, CAST(length(json) AS INTEGER) AS chars, md5(json) AS digest FROM stored WHERE json IS NOT NULL", TEXT)
oracle("ping_payload_extract", "SELECT 'dummy' AS k, md5(json) AS digest FROM stored WHERE json IS NOT NULL", TEXT)
plain("retention_filter", """SELECT name, CAST(age_days AS INTEGER) AS age_days, age_days > 180 AS expired FROM (
  SELECT DISTINCT 'agg_valid_' || strftime(o_orderdate, '%Y%m') AS name,
         date_diff('day', CAST(date_trunc('month', o_orderdate) AS DATE), DATE '1997-01-15') AS age_days FROM orders)""")
oracle("completeness_audit", """SELECT strftime(day, '%Y%m%d') AS d, dataset, CASE WHEN n IS NULL THEN 'MISSING' ELSE 'EMPTY' END AS status
  FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS day)
  CROSS JOIN (VALUES (0, 'hangs'), (1, 'flash-versions'), (2, 'mobile-flash-versions'), (3, 'shutdown-times'), (4, 'slowsql-main'), (5, 'slowsql-other')) s(i, dataset)
  LEFT JOIN (SELECT u % 5 AS i, d, count(*) FILTER (WHERE kind <> 'click') AS n FROM facts
             WHERE CAST(substr(d, 7, 2) AS INTEGER) % 7 <> u % 5 GROUP BY 1, 2) f ON f.i = s.i AND f.d = strftime(day, '%Y%m%d')
  WHERE n IS NULL OR n = 0""")
ORACLES["storage_audit"] = ORACLES["completeness_audit"]
plain("retention_on_storage", """SELECT 'agg=valid_' || strftime(month, '%Y%m') AS name, CAST(date_diff('day', CAST(month AS DATE), DATE '1997-01-15') AS INTEGER) AS age_days,
  date_diff('day', CAST(month AS DATE), DATE '1997-01-15') > 180 AS expired, false AS deleted_dry, date_diff('day', CAST(month AS DATE), DATE '1997-01-15') > 180 AS deleted,
  CASE WHEN date_diff('day', CAST(month AS DATE), DATE '1997-01-15') <= 180 THEN n END AS n
  FROM (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1)""")
LINES = """lines AS (SELECT *, hist_sum % 11 AS damage, CASE hist_sum % 11 WHEN 9 THEN '' ELSE concat_ws(chr(9), id, date_str, os, hist_value,
    CASE WHEN hist_sum % 11 <> 3 THEN CAST(hist_value_count AS VARCHAR) END, CASE WHEN hist_sum % 11 = 7 THEN 'more' END) END AS line FROM (
  SELECT CAST(u AS VARCHAR) AS id, d AS date_str, CASE u % 3 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Linux' ELSE 'Darwin' END AS os,
    CASE WHEN e % 37 = 3 THEN 'bad' ELSE CAST(n AS VARCHAR) END AS hist_value, 1 + e % 3 AS hist_value_count, n * (1 + e % 3) AS hist_sum FROM facts))"""
oracle("checked_lines", """SELECT id, date_str, os, CAST(hist_value AS DOUBLE) AS hist_value, CAST(hist_value_count AS BIGINT) AS hist_value_count
  FROM lines WHERE damage NOT IN (3, 7, 9) AND hist_value <> 'bad'""", LINES)
oracle("rejected_lines", """SELECT CASE WHEN damage = 9 THEN 'empty' WHEN damage IN (3, 7) THEN 'fields' ELSE 'value: hist_value' END AS reason, line, count(*) AS n
  FROM lines WHERE damage IN (3, 7, 9) OR hist_value = 'bad' GROUP BY ALL""", LINES)

# Nested access and projection
oracle("json_parse", "SELECT k, ok AS parsed, CASE WHEN ok THEN 1 END AS ver FROM docs")
oracle("json_nested_get", """SELECT k, product, CASE WHEN has_info THEN CAST(u % 4 + 1 AS INTEGER) END AS cpucount,
  CASE WHEN has_measures THEN CAST(e % 3 AS INTEGER) END AS e4x,
  CASE WHEN has_hist THEN CASE WHEN e % 50 = 8 THEN 13 ELSE 12 END END AS bucket_count, CAST(NULL AS VARCHAR) AS missing FROM subs""")
oracle("project_dims", f"SELECT k, {DIMS} FROM subs")
oracle("select_fields", f"""SELECT k, os AS "OS", CASE WHEN has_measures THEN CAST({PAINT} AS VARCHAR) END AS "firstPaint",
  CASE WHEN has_info THEN CASE WHEN u % 2 = 0 THEN 'en-US' ELSE 'de' END END AS locale, CASE WHEN ok THEN '1' END AS ver FROM subs""")
ROW_FIELDS = "hist_name, v, count, sum, bucket_count, min_range, max_range, hist_type, is_valid"
oracle("single_histogram", f"SELECT k, version AS appVersion, {ROW_FIELDS} FROM points WHERE hist_name = 'PAUSE_MS' AND count <> 0",
       "kept AS (SELECT * FROM subs)", ENTRIES, POINTS)
oracle("flag_projection", """SELECT k, CASE WHEN armv6 THEN 1 ELSE 0 END AS has_armv6, CASE WHEN armv7 THEN 1 ELSE 0 END AS has_armv7,
  CASE WHEN has_hist AND e % 7 = 0 THEN 1 ELSE 0 END AS has_oom_killed, coalesce(flash, 'NA') AS flash_version FROM subs""")
SAMPLE = "CAST(('0x' || substr(md5(k), 1, 15)) AS BIGINT)"
oracle("sample_hash", f"SELECT k FROM base WHERE {SAMPLE} < {int(0.25 * 2**60)}")
BUCKET = f"CASE WHEN channel IN ('nightly', 'aurora', 'beta') THEN 'prerelease' WHEN channel = 'release' AND {SAMPLE} < {int(0.1 * 2**60)} THEN 'release' END"
oracle("export_split", f"SELECT s.k, md5(t.json) AS digest, {BUCKET.replace('(k)', '(s.k)')} AS bucket FROM subs s JOIN stored t USING (k) WHERE {BUCKET.replace('(k)', '(s.k)')} IS NOT NULL", TEXT)
oracle("export_union", f"SELECT d, count(*) AS n FROM subs WHERE {BUCKET} IS NOT NULL GROUP BY d")

# Filters
oracle("filter_product_reason", "SELECT k FROM kept", KEPT)
oracle("filter_not_null", "SELECT k FROM subs WHERE version IS NOT NULL AND has_slow")
oracle("filter_is_map", """SELECT k, has_info AS info_is_map, has_hist AS histograms_is_map, has_measures AS "simpleMeasurements_is_map",
  ok AND e % 20 = 0 AS "chromeHangs_is_map" FROM subs""")
oracle("hang_filter", "SELECT b.k, t.json FROM base b JOIN stored t USING (k) WHERE b.ok AND (b.e % 40 = 20 OR b.e % 30 = 0)", TEXT)
oracle("having_threshold", "SELECT thread, sql, count(*) AS doc_count FROM statements GROUP BY thread, sql HAVING count(*) > 100", SLOW)
oracle("filter_in_list", "SELECT k, version AS product_version FROM subs WHERE version IN ('18.0.1', '9.0', '7.0')")

PAINTS = """paints AS (SELECT CASE WHEN l_linenumber <= 4 THEN '10.0a1' ELSE '9.0' END AS version,
  CASE WHEN l_returnflag = 'N' THEN 'WINNT' ELSE 'Linux' END AS os, CASE WHEN l_linestatus = 'O' THEN '6.1' ELSE '5.1' END AS osversion,
  l_orderkey % 2 AS si, CASE WHEN l_partkey % 31 <> 0 THEN CAST(floor(l_extendedprice) AS BIGINT) - 1500 END AS firstpaint,
  CASE WHEN l_suppkey % 17 <> 0 THEN CAST(floor(l_extendedprice / 3) AS BIGINT) + l_linenumber * 500 END AS sessionrestored,
  CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_quantity AS BIGINT) END AS places, CAST(floor(l_extendedprice / 2) AS BIGINT) AS ndco FROM lineitem)"""
RELEASE = "version = '10.0a1' AND os = 'WINNT' AND osversion = '6.1'"
COHORT = f"cohort AS (SELECT * FROM paints WHERE {RELEASE} AND si IN (0, 1) AND firstpaint > 0)"


def paints(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ",\n".join([PAINTS, *ctes]) + "\n" + select


paints("drop_incomplete", """SELECT version, firstpaint, sessionrestored, places FROM paints
  WHERE version IS NOT NULL AND firstpaint IS NOT NULL AND sessionrestored IS NOT NULL AND places IS NOT NULL""")
PAUSE_VALUES = "has_hist AND e % 50 <> 6"
oracle("value_compare", f"""SELECT k, has_hist AS bucket_over_50, coalesce({PAUSE_VALUES} AND n - n % 10 = 90, false) AS bucket_equal_90,
  has_hist AND e % 50 NOT IN (1, 7) AND n * (1 + e % 3) <= 20 AS sum_at_most_20, has_measures AND {PAINT} >= 9000 AS paint_at_least_9000,
  has_measures AND e % 3 = 0 AS shutdown_present, has_hist AND e % 50 = 1 AS sum_is_null, has_info AND u % 3 = 1 AS os_is_linux,
  has_info AND u % 3 <> 1 AS os_not_linux, has_info AND u % 2 = 0 AS armv6_true, has_info AND u % 4 + 1 < 3 AS cpus_under_3,
  false AS unknown_key FROM docs""")
oracle("conjunctive_filter", f"SELECT k FROM docs WHERE has_measures AND {PAINT} > 2000 AND has_info AND u % 3 = 0 AND has_hist AND e % 2 = 1")

# Row generators
NAME_FIELDS = "hist_name, sum, bucket_count, min_range, max_range, hist_type, is_valid"
oracle("hist_by_name_rows", f"SELECT k, {NAME_FIELDS} FROM entries", KEPT, ENTRIES)
oracle("hist_by_value_rows", f"SELECT k, {ROW_FIELDS} FROM points", KEPT, ENTRIES, POINTS)
oracle("simple_measure_rows", f"SELECT k, {ROW_FIELDS} FROM points", "kept AS (SELECT * FROM subs)", f"entries AS ({MEASURES})", POINTS)
oracle("histogram_names", """SELECT hist_name, count(*) AS n FROM (
  SELECT unnest(['PAUSE_MS', 'CYCLE_MS', 'USED_FLAG']) AS hist_name FROM docs WHERE has_hist
  UNION ALL SELECT 'OUT_OF_MEMORY_KILLED' FROM docs WHERE has_hist AND e % 7 = 0
  UNION ALL SELECT 'EXTRA_' || CAST(u % 3 AS VARCHAR) FROM docs WHERE has_hist AND e % 5 = 0
  UNION ALL SELECT 'SIMPLE_MEASURES_' || unnest(['UPTIME', 'FIRSTPAINT', 'STARTUPINTERRUPTED', 'STARTUPCRASHDETECTIONEND', 'SAVEDPINGS', 'JS', 'SESSIONRESTORED'])
    FROM docs WHERE has_measures
  UNION ALL SELECT 'SIMPLE_MEASURES_SHUTDOWNDURATION' FROM docs WHERE has_measures AND e % 3 = 0) GROUP BY hist_name""")
oracle("slowsql_rows", "SELECT k, thread, sql, CAST(count AS BIGINT) AS count, CAST(t AS BIGINT) AS t FROM statements", SLOW)
oracle("flatten_rows", """SELECT hist_name, CAST(edge AS INTEGER) AS edge, count(*) AS n FROM (
  SELECT 'PAUSE_MS' AS hist_name, unnest(CASE WHEN e % 50 = 5 THEN [1] ELSE [1, 100] END) AS edge FROM docs WHERE has_hist
  UNION ALL SELECT 'CYCLE_MS', unnest([1, 7]) FROM docs WHERE has_hist
  UNION ALL SELECT 'USED_FLAG', unnest([1, 2]) FROM docs WHERE has_hist
  UNION ALL SELECT 'OUT_OF_MEMORY_KILLED', unnest([1, 2]) FROM docs WHERE has_hist AND e % 7 = 0
  UNION ALL SELECT 'EXTRA_' || CAST(u % 3 AS VARCHAR), unnest([1, 10]) FROM docs WHERE has_hist AND e % 5 = 0) GROUP BY 1, 2""")

# Scalar functions
oracle("null_default", "SELECT k, channel_na AS product_channel FROM subs")
oracle("os_version_normalize", """SELECT kernel AS version, os_version, kernel_cut AS normalized_kernel_version, count(*) AS n FROM subs GROUP BY ALL""")
oracle("kernel_to_android", "SELECT k, kernel AS kernel_version, android AS os_version FROM subs")
oracle("submission_stats", """SELECT d, count(*) AS count, CAST(sum(length(json)) AS BIGINT) AS sum_size, round(avg(length(json)) + 1e-9, 6) AS avg_size
  FROM stored GROUP BY d""", TEXT)
BY_PRODUCT = """by_product AS (SELECT s.d, product, version AS product_version, count(*) AS count, CAST(sum(length(json)) AS BIGINT) AS sum_size,
  avg(length(json)) AS avg_size FROM subs s JOIN stored t USING (k) GROUP BY ALL)"""
oracle("submission_stats_by_product", "SELECT d, product, product_version, count, sum_size, round(avg_size + 1e-9, 6) AS avg_size FROM by_product", TEXT, BY_PRODUCT)
oracle("single_report_file", "SELECT d, product, product_version, count, sum_size FROM by_product", TEXT, BY_PRODUCT)
MINUTES = "CAST(floor(x * 10) AS BIGINT) - CASE WHEN e % 11 = 0 THEN 50 ELSE 0 END"
oracle("bucket_uptime", f"SELECT e, {MINUTES} AS minutes, CAST({uptime(f'({MINUTES})')} AS BIGINT) AS bucket FROM facts")
T = "(CAST(floor(x * 300) AS BIGINT) - 500)"
oracle("bucket_generic", f"""SELECT e, CAST({grid(T, 0, 30000, 1000)} AS BIGINT) AS other, CAST({grid(T, 30000, 90000, 2000)} AS BIGINT) AS crash,
  CAST({grid('n', 0, 50, 1)} AS BIGINT) AS pings FROM facts""")
AVERAGE = "CASE WHEN count <> 0 THEN CAST(t AS DOUBLE) / count END"
oracle("avg_time_ratio", f"SELECT k, thread, CAST(count AS BIGINT) AS count, CAST(t AS BIGINT) AS t, round({AVERAGE} + 1e-9, 6) AS avg_time FROM statements", SLOW)
QUOTED = r"""regexp_replace(sql, '''[^''\\]*(?:\\.[^''\\]*)*''', ':private', 'gs')"""
plain("mask_sql_literals", rf"""WITH rows AS (SELECT doc_id, 'INSERT ''' || lang || '\''s'' x "' || source || '" ' || text AS sql FROM documents)
  SELECT doc_id, md5(regexp_replace({QUOTED}, '"[^"\\]*(?:\\.[^"\\]*)*"', ':private', 'g')) AS masked,
    md5(regexp_replace({QUOTED}, '''[^"\\]*(?:\\.[^"\\]*)*"', ':private', 'g')) AS masked_compat FROM rows""".replace("'gs'", "'g'"))
PRINT = [
    "reason", "os", "NULL", "build", "product", "plat_build", "channel", "CASE WHEN u % 2 = 0 THEN 'en-US' ELSE 'de' END",
    "CAST(u % 4 + 1 AS VARCHAR)", "arch", "kernel", *["NULL"] * 11, "CASE WHEN armv6 THEN 'true' ELSE 'false' END",
    "CASE WHEN armv7 THEN 'true' WHEN NOT armv7 THEN 'false' END", *["NULL"] * 9, "flash",
]
oracle("config_fingerprint", "SELECT md5(" + " || chr(31) || ".join(f"coalesce('=' || {p}, '')" for p in PRINT)
       + ") AS fingerprint, count(*) AS n FROM subs WHERE has_info GROUP BY 1")
oracle("date_parse", "SELECT k, CAST(strptime(d, '%Y%m%d') AS DATE) AS date FROM base")
oracle("major_version", "SELECT version, CAST(split_part(version, '.', 1) AS INTEGER) AS version_major, count(*) AS n FROM subs GROUP BY ALL")
CLAMPED = "CASE WHEN firstpaint IS NULL OR firstpaint < 0 THEN -1 WHEN firstpaint > 30000 THEN 31000 ELSE firstpaint END"
paints("clamp_recode", f"SELECT {CLAMPED} AS firstpaint, CASE WHEN ndco > 30000 THEN 31000 ELSE ndco END AS ndco, count(*) AS n FROM paints GROUP BY ALL")
paints("minmax_scale", """SELECT firstpaint, round(CAST(firstpaint - (SELECT min(firstpaint) FROM paints) AS DOUBLE)
  / ((SELECT max(firstpaint) FROM paints) - (SELECT min(firstpaint) FROM paints)) + 1e-9, 6) AS scaled, count(*) AS n
  FROM paints WHERE firstpaint IS NOT NULL GROUP BY ALL""")

# Aggregates of histograms
oracle("count_by_version", f"SELECT version AS product_version, count(*) AS cnt FROM subs WHERE product = '{DESKTOP}' AND version IS NOT NULL GROUP BY version")
oracle("expansion_warnings", """SELECT (SELECT count(*) FROM kept WHERE e % 50 IN (1, 6, 7)) AS bad_histograms,
  (SELECT count(*) FROM kept WHERE e % 53 = 5) AS bad_measures, (SELECT count(*) FROM kept WHERE e % 50 = 2) AS bad_buckets,
  (SELECT count(*) FROM entries WHERE arch IS NULL OR version IS NULL) AS null_dimensions""", KEPT, ENTRIES)
oracle("hist_name_totals", "SELECT * FROM name_totals", KEPT, ENTRIES, NAME_TOTALS)
oracle("hist_value_totals", "SELECT * FROM value_totals", KEPT, ENTRIES, POINTS, VALUE_TOTALS)
for _name in ("hist_join_name_value", "daily_aggregates", "stored_daily_aggregates"):
    oracle(_name, "SELECT * FROM joined", KEPT, ENTRIES, POINTS, NAME_TOTALS, VALUE_TOTALS, JOINED)
SUMMARY = f"""SELECT substr(d, 1, 6) AS month, d AS date, reason, product AS "appName", product_version AS "appVersion",
  product_channel AS "appUpdateChannel", arch, os AS "OS", os_version AS version, app_build_id AS "appBuildID", plat_build_id AS "platformBuildID",
  is_valid = 1 AS valid, names, hist_name, CAST(count(*) AS INTEGER) AS n_values, CAST(sum(v * CAST(sum_count AS BIGINT)) AS BIGINT) AS weighted,
  max(hist_name_doc_count) AS count, max(hist_name_sum) AS sum, max(bucket_count) AS bucket_count, min(min_range) AS low, max(max_range) AS high,
  max(hist_type) AS histogram_type
  FROM joined JOIN (SELECT {DIM_NAMES}, is_valid, string_agg(DISTINCT hist_name, ',' ORDER BY hist_name) AS names FROM joined GROUP BY ALL) g
    USING ({DIM_NAMES}, is_valid) GROUP BY {NAME_KEYS}, names"""
oracle("aggregate_json_docs", SUMMARY, KEPT, ENTRIES, POINTS, NAME_TOTALS, VALUE_TOTALS, JOINED)
MONTH_KEYS = NAME_KEYS.replace("d, reason", "month, reason", 1)
oracle("kept_month_totals", f"""SELECT v.*, n.sum_sum AS hist_name_sum, n.doc_count AS hist_name_doc_count
  FROM (SELECT substr(d, 1, 6) AS month, * EXCLUDE (d, bucket_count, min_range, max_range, hist_type, sum_count), max(bucket_count) AS bucket_count,
          min(min_range) AS min_range, max(max_range) AS max_range, max(hist_type) AS hist_type, sum(sum_count) AS sum_count FROM value_totals GROUP BY ALL) v
  JOIN (SELECT substr(d, 1, 6) AS month, * EXCLUDE (d, sum_sum, doc_count), CAST(sum(sum_sum) AS BIGINT) AS sum_sum, CAST(sum(doc_count) AS BIGINT) AS doc_count
        FROM name_totals GROUP BY ALL) n USING ({MONTH_KEYS})""", KEPT, ENTRIES, POINTS, NAME_TOTALS, VALUE_TOTALS)
oracle("unfit_totals", """SELECT hist_name, CAST(sum_sum AS VARCHAR) AS sum_sum, doc_count FROM (
  SELECT hist_name, sum(CAST(sum AS HUGEINT) * 1099511627776) AS sum_sum, count(*) AS doc_count FROM entries GROUP BY hist_name)
  WHERE sum_sum > 9223372036854775807 OR sum_sum < -9223372036854775808""", KEPT, ENTRIES)

# Slow SQL: place of a quantile in exact integer arithmetic, by numbered rows
QUANTILES = {"q0": (0, 1), "q25": (1, 4), "q50": (1, 2), "q75": (3, 4), "q95": (19, 20), "q100": (1, 1)}
REPORT_KEYS = "thread, d, product, product_version, product_channel, sql"


def report(having: str = "true", lower_only: bool = False) -> str:
    if lower_only:
        picks = ", ".join(
            f"max(CASE WHEN r = greatest((c * {p} + {q - 1}) // {q}, 1) THEN avg_time END) AS {name}" for name, (p, q) in QUANTILES.items()
        )
    else:
        picks = average_picks()
    return f"""SELECT {REPORT_KEYS}, count(*) AS doc_count, CAST(sum(count) AS BIGINT) AS sum_count, {picks} FROM (
      SELECT *, row_number() OVER (PARTITION BY {REPORT_KEYS}, avg_time IS NULL ORDER BY avg_time) * CASE WHEN avg_time IS NULL THEN -1 ELSE 1 END AS r,
        count(avg_time) OVER (PARTITION BY {REPORT_KEYS}) AS c FROM (
        SELECT thread, d, product, version AS product_version, channel AS product_channel, sql, count, {AVERAGE} AS avg_time FROM statements))
      GROUP BY {REPORT_KEYS} HAVING {having}"""


def average_picks() -> str:
    return ", ".join(
        f"round((max(CASE WHEN r = greatest((c * {p} + {q - 1}) // {q}, 1) THEN avg_time END)"
        f" + max(CASE WHEN r = least(c * {p} // {q} + 1, c) THEN avg_time END)) / 2 + 1e-9, 6) AS {name}"
        for name, (p, q) in QUANTILES.items()
    )


oracle("slowsql_quantiles", report(), SLOW)
oracle("slowsql_quantiles_selected", report(), SLOW)
WEEK = f"""week AS (SELECT thread, product, version AS product_version, channel AS product_channel, sql, count, {AVERAGE} AS avg_time
  FROM statements WHERE d BETWEEN '20240105' AND '20240112')"""
oracle("slowsql_sketch_report", """SELECT thread, product, product_version, product_channel, sql, count(*) AS doc_count, CAST(sum(count) AS BIGINT) AS sum_count,
  count(avg_time) AS n, round(min(avg_time) + 1e-9, 6) AS q0, round(max(avg_time) + 1e-9, 6) AS q100 FROM week GROUP BY ALL HAVING count(*) > 5""", SLOW, WEEK)
oracle("slowsql_sketch_errors", """SELECT thread, quantile, count(avg_time) AS n, false AS beyond
  FROM week CROSS JOIN (VALUES ('q0'), ('q25'), ('q50'), ('q75'), ('q95'), ('q100')) asked(quantile) GROUP BY ALL""", SLOW, WEEK)
# Sketches are exact for groups smaller than their accuracy: the value at the place itself.
oracle("slowsql_quantiles_approx", report(lower_only=True), SLOW)
oracle("slowsql_report", report("count(*) > 5"), SLOW_MASKED)
oracle("privacy_scrub", """SELECT k, thread, sql, CAST(count AS BIGINT) AS count, CAST(t AS BIGINT) AS t FROM statements WHERE e % 8 <> 0""", SLOW_MASKED)

# Validation
SPEC_KEY = "CASE version WHEN '16.0' THEN '16' WHEN '18.0.1' THEN '18' WHEN '21.0a1' THEN '1' WHEN '9.0' THEN 'default' END"
oracle("spec_version_match", f"SELECT k, version AS product_version, {SPEC_KEY} AS spec_key FROM subs")
CHECKED = f"""
checked AS (
  SELECT *, {SPEC_KEY} AS spec_key FROM subs WHERE version IS NOT NULL AND has_hist),
results AS (
  SELECT k, e, spec_key, 'PAUSE_MS' AS hist_name, false AS bad_type, false AS bad_min, e % 50 = 5 AS bad_max, e % 50 = 8 AS bad_bucket_count,
    e % 50 = 6 AS no_buckets, e % 50 <> 6 AND spec_key <> '1' AND (e % 50 = 2 OR (spec_key = '18' AND n >= 90)) AS bad_bucket, true AS known FROM checked
  UNION ALL SELECT k, e, spec_key, 'CYCLE_MS', false, false, spec_key = '1', false, false, false, true FROM checked
  UNION ALL SELECT k, e, spec_key, 'USED_FLAG', false, false, false, false, false, false, true FROM checked
  UNION ALL SELECT k, e, spec_key, 'OUT_OF_MEMORY_KILLED', false, false, false, false, false, false, spec_key = 'default' FROM checked WHERE e % 7 = 0
  UNION ALL SELECT k, e, spec_key, 'EXTRA_' || CAST(u % 3 AS VARCHAR), false, false, false, false, false, false, false FROM checked WHERE e % 5 = 0),
verdicts AS (
  SELECT *, CASE WHEN known THEN NOT (bad_type OR bad_min OR bad_max OR bad_bucket_count OR no_buckets OR bad_bucket) END AS valid FROM results)"""
JUDGED = """entries AS (SELECT p.* REPLACE (CASE WHEN v.valid IS NULL THEN p.is_valid WHEN v.valid THEN 1 ELSE 0 END AS is_valid)
  FROM planted p LEFT JOIN verdicts v ON p.k = v.k AND p.hist_name = v.hist_name)"""
oracle("validated_aggregates", SUMMARY, KEPT, ENTRIES.replace("entries AS", "planted AS", 1), CHECKED, JUDGED, POINTS, NAME_TOTALS, VALUE_TOTALS, JOINED)
CHECK_NAMES = ["bad_type", "bad_min", "bad_max", "bad_bucket_count", "no_buckets", "bad_bucket"]
oracle("validate_histograms", "SELECT k, spec_key, hist_name, valid, " + ", ".join(f"CASE WHEN known THEN {c} END AS {c}" for c in CHECK_NAMES)
       + " FROM verdicts", CHECKED)
PER_DOC = """per_doc AS (SELECT k, bool_and(coalesce(valid, true)) AS all_valid,
  coalesce(string_agg(CASE WHEN valid THEN hist_name END, ',' ORDER BY hist_name), '') AS passed,
  coalesce(string_agg(CASE WHEN NOT valid THEN hist_name END, ',' ORDER BY hist_name), '') AS failed FROM verdicts GROUP BY k)"""
oracle("validate_docs", """SELECT k, CASE WHEN all_valid THEN 'true' ELSE 'false' END AS valid_for_schema, product,
  CASE WHEN p.k IS NOT NULL THEN passed WHEN has_hist THEN '' END AS passed,
  CASE WHEN p.k IS NOT NULL THEN failed WHEN has_hist THEN CASE WHEN e % 50 = 3 THEN 'PAUSE_MS' ELSE '' END END AS failed,
  CASE WHEN has_hist THEN CAST(3 + CASE WHEN e % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN e % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS n_histograms
  FROM subs LEFT JOIN per_doc p USING (k) WHERE ok""", CHECKED, PER_DOC)
oracle("count_valid_invalid", """SELECT count(*) AS all_docs, count(*) FILTER (WHERE ok AND all_valid) AS valid_docs,
  count(*) FILTER (WHERE ok AND all_valid IS DISTINCT FROM true) AS invalid_docs FROM subs LEFT JOIN per_doc USING (k)""", CHECKED, PER_DOC)
for _name in ("validation_report", "validation_write_back"):
    oracle(_name, """SELECT (SELECT count(*) FROM subs) AS documents, (SELECT count(*) FROM subs WHERE null_json) AS meta_data_invalid,
  (SELECT count(*) FROM subs WHERE bad_json) AS invalid_json_structure, (SELECT count(*) FROM subs WHERE version IS NOT NULL) AS submissions_evaluated,
  count(*) FILTER (WHERE known) AS known_histograms, count(*) FILTER (WHERE NOT known) AS unknown_histograms,
  count(*) FILTER (WHERE bad_type) AS invalid_histogram_type, count(*) FILTER (WHERE bad_min) AS invalid_histogram_min,
  count(*) FILTER (WHERE bad_max) AS invalid_histogram_max, count(*) FILTER (WHERE bad_bucket_count) AS invalid_histogram_bucket_count,
  count(*) FILTER (WHERE no_buckets) AS no_histogram_bucket_values, count(*) FILTER (WHERE bad_bucket) AS invalid_histogram_bucket_value,
  count(*) FILTER (WHERE valid) AS valid_histogram, count(*) FILTER (WHERE NOT valid) AS invalid_histogram FROM verdicts""", CHECKED)

# Counts by configuration
FLASH = """SELECT product, version AS product_version, channel_na AS product_channel, os, os_version, coalesce(flash, 'NA') AS flash_version,
  count(*) AS cnt FROM subs WHERE {} AND {} GROUP BY ALL"""
oracle("flash_versions", FLASH.format(COMPLETE, f"product IN ('{DESKTOP}', '{TOUCH}') AND os = 'WINNT'"))
oracle("mobile_flash_versions", FLASH.format(COMPLETE, f"product = '{MOBILE}'"))
oracle("oom_killed_counts", f"""SELECT d, reason, version AS product_version, channel_na AS product_channel, arch,
  CASE WHEN armv6 THEN 1 ELSE 0 END AS has_armv6, CASE WHEN armv7 THEN 1 ELSE 0 END AS has_armv7, os, android AS os_version,
  kernel_cut AS normalized_kernel_version, kernel AS kernel_version, CASE WHEN e % 7 = 0 THEN 1 ELSE 0 END AS has_oom_killed, count(*) AS cnt
  FROM subs WHERE {COMPLETE} AND product = '{MOBILE}' GROUP BY ALL""")

# Hangs
MOD, MOD_7 = "u % 25", "(u + 7) % 25"


def frame(kind: str, stack: int, number: int, module: str | None, offset: str, where: str) -> str:
    if module is None:
        owner = "CAST(NULL AS VARCHAR) AS module, CAST(NULL AS VARCHAR) AS debug_id"
    else:
        owner = f"'mod' || CAST({module} AS VARCHAR) AS module, 'D' || CAST({module} AS VARCHAR) || 'A' AS debug_id"
    return (f"SELECT k, d, '{kind}' AS kind, {stack} AS stack_no, {number} AS frame_no, {owner}, "
            f"CAST({offset} AS BIGINT) AS \"offset\" FROM docs WHERE ok AND {where}")


FRAMES = "frames AS (" + " UNION ALL ".join([
    frame("hang", 0, 0, MOD, "e * 31 % 12000", "e % 40 = 20"),
    frame("hang", 0, 1, MOD_7, "e * 17 % 12000", "e % 40 = 20"),
    frame("hang", 0, 2, None, "e % 1000", "e % 40 = 20"),
    frame("hang", 1, 0, MOD, "e * 17 % 12000", "e % 40 = 20 AND e % 3 = 1"),
    frame("late_write", 0, 0, MOD, "e * 31 % 12000", "e % 30 = 0"),
    frame("late_write", 0, 1, MOD, "e % 1000", "e % 30 = 0"),
]) + ")"
SYMBOLS = """syms AS (SELECT 'mod' || CAST(p_partkey % 25 AS VARCHAR) AS module, p_partkey * 37 % 10007 AS start,
  p_name || '_' || CAST(p_partkey AS VARCHAR) AS name FROM part),
named AS (SELECT f.*, s.name AS symbol FROM frames f ASOF LEFT JOIN syms s ON f.module = s.module AND f."offset" >= s.start)"""
oracle("symbolicate_frames", """SELECT k, kind, stack_no, frame_no, module, debug_id, "offset", symbol FROM named""", FRAMES, SYMBOLS)
STACKS = """stacks AS (SELECT k, kind, stack_no, string_agg(coalesce(symbol, '0x' || lower(to_hex("offset"))), chr(10) ORDER BY frame_no) AS text
  FROM named GROUP BY ALL),
texts_of AS (SELECT k, kind, string_agg(text, '|' ORDER BY stack_no) AS text FROM stacks GROUP BY ALL)"""
oracle("hang_report", """SELECT d, substr(b.k, 10) AS uuid,
  CAST(CASE WHEN e % 20 = 0 THEN 1 ELSE 0 END + CASE WHEN e % 30 = 0 THEN 1 ELSE 0 END
    + CASE WHEN e % 20 = 15 THEN 1 ELSE 0 END AS INTEGER) AS lookups,
  CAST(CASE WHEN e % 40 = 0 THEN 1 ELSE 0 END AS INTEGER) AS errors, coalesce(h.text, '') AS hang_stacks, coalesce(w.text, '') AS late_write_stacks,
  product, false AS has_histograms
  FROM subs b LEFT JOIN texts_of h ON h.k = b.k AND h.kind = 'hang' LEFT JOIN texts_of w ON w.k = b.k AND w.kind = 'late_write'
  WHERE ok AND (e % 40 = 20 OR e % 30 = 0)""", FRAMES, SYMBOLS, STACKS)

oracle("hang_text_report", """SELECT line, count(*) AS n FROM (
  SELECT d || chr(9) || substr(k, 10) AS line FROM subs WHERE ok AND (e % 40 = 20 OR e % 30 = 0)
  UNION ALL SELECT unnest(string_split(replace(text, '|', chr(10)), chr(10))) FROM texts_of JOIN subs USING (k) WHERE ok AND (e % 40 = 20 OR e % 30 = 0)
  UNION ALL SELECT '----- ' || edge || CASE kind WHEN 'hang' THEN ' HANG' ELSE ' LATE WRITE' END || ' STACK -----'
  FROM (SELECT texts_of.kind, unnest(string_split(text, '|')) AS stack FROM texts_of JOIN subs USING (k) WHERE ok AND (e % 40 = 20 OR e % 30 = 0))
  CROSS JOIN (VALUES ('BEGIN'), ('END')) edges(edge)) GROUP BY line""", FRAMES, SYMBOLS, STACKS)

# Ad-hoc queries
oracle("adhoc_query", f"""SELECT k, product AS "appName", CAST({PAINT} AS VARCHAR) AS "firstPaint", {ROW_FIELDS} FROM points
  WHERE hist_name = 'CYCLE_MS' AND count <> 0 AND d BETWEEN '20240105' AND '20240112' AND has_measures AND {PAINT} > 1000
    AND version IS NOT NULL AND {SAMPLE} < {int(0.5 * 2**60)}""", "kept AS (SELECT * FROM subs)", ENTRIES, POINTS)
oracle("shutdown_times", f"""SELECT CAST(n * 100 AS VARCHAR) AS "shutdownDuration", os AS "OS", version AS "appVersion", build AS "appBuildID" FROM subs
  WHERE has_measures AND e % 3 = 0 AND d BETWEEN '20240105' AND '20240112' AND {SAMPLE} < {int(0.25 * 2**60)}""")

# Statistics
DATE = "CAST(strptime(d, '%Y%m%d') AS DATE) AS date"
oracle("two_level_average", f"""SELECT date, os, round(avg(avg_time) + 1e-9, 6) AS avg_time, round(median(avg_time) + 1e-9, 6) AS median_time, sum(sum_count) AS sum_count FROM (
  SELECT u, {DATE}, CASE u % 3 WHEN 0 THEN 'WINNT' WHEN 1 THEN 'Linux' ELSE 'Darwin' END AS os, CAST(sum(1 + e % 3) AS DOUBLE) AS sum_count,
    CAST(sum(n * (1 + e % 3)) AS DOUBLE) / sum(1 + e % 3) AS avg_time FROM facts WHERE e % 37 <> 3 GROUP BY ALL) GROUP BY ALL""")
oracle("gc_ratio_stats", f"""SELECT date, version, round(sum(n) + 1e-9, 6) AS sum_sum_count, round(median(n) + 1e-9, 6) AS median_sum_count, round(avg(n) + 1e-9, 6) AS avg_sum_count,
  round(stddev_samp(n) + 1e-9, 6) AS sd_sum_count, round(median(ratio) + 1e-9, 6) AS median_ratio, round(avg(ratio) + 1e-9, 6) AS avg_ratio, round(stddev_samp(ratio) + 1e-9, 6) AS sd_ratio FROM (
  SELECT {DATE}, CASE u % 3 WHEN 0 THEN '16.0' WHEN 1 THEN '18.0.1' ELSE '21.0a1' END AS version, CAST(n AS DOUBLE) AS n,
    CASE WHEN floor(x) <> 0 THEN n / floor(x) END AS ratio FROM facts WHERE n <> 0 OR floor(x) <> 0) GROUP BY ALL""")
SQL_ROWS = """sql_rows AS (SELECT 'SELECT * FROM ' || kind || ' WHERE n = ' || CAST(n % 10 AS VARCHAR) AS sql, e % 5 AS count,
  CAST(floor(x) AS BIGINT) AS time, CASE WHEN e % 5 <> 0 THEN floor(x) / (e % 5) END AS rate FROM facts)"""
oracle("group_stats", """SELECT sql, round(CAST(sum(count) AS DOUBLE) + 1e-9, 6) AS count, round(CAST(sum(time) AS DOUBLE) + 1e-9, 6) AS time,
  round(CAST(sum(time) AS DOUBLE) / nullif(sum(count), 0) + 1e-9, 6) AS avg_time, round(avg(rate) + 1e-9, 6) AS avg_avg_time, round(median(rate) + 1e-9, 6) AS median_avg_time,
  round(stddev_samp(rate) + 1e-9, 6) AS sd_avg_time FROM sql_rows GROUP BY sql""", SQL_ROWS)
MEANS = "means AS (SELECT sql, CAST(sum(count) AS BIGINT) AS count, round(avg(rate) + 1e-9, 6) AS avg_time FROM sql_rows GROUP BY sql)"
oracle("mean_ratio_by_sql", "SELECT * FROM means", SQL_ROWS, MEANS)
oracle("slow_sql_by_time", """SELECT sql, CAST(count AS DOUBLE) AS count, CAST(time AS DOUBLE) AS time, round(rate + 1e-9, 6) AS avg_time,
  row_number() OVER (ORDER BY time DESC, sql, count) AS idx FROM sql_rows""", SQL_ROWS)
oracle("slow_sql_by_count", """SELECT sql, count, round(middle + 1e-9, 6) AS median_avg_time, row_number() OVER (ORDER BY count DESC, sql) AS idx FROM (
  SELECT sql, CAST(sum(count) AS DOUBLE) AS count, median(rate) AS middle FROM sql_rows GROUP BY sql)""", SQL_ROWS)
oracle("rank_by_ratio", "SELECT sql, avg_time, row_number() OVER (ORDER BY avg_time NULLS FIRST, sql) AS idx FROM means", SQL_ROWS, MEANS)
oracle("top_n", "SELECT * FROM means ORDER BY avg_time DESC NULLS LAST, sql LIMIT 20", SQL_ROWS, MEANS)
PAIRS = f"pairs AS (SELECT firstpaint AS x, places AS y FROM paints WHERE {RELEASE} AND firstpaint IS NOT NULL AND places IS NOT NULL)"
paints("corr_pearson", "SELECT round(corr(x, y) + 1e-9, 6) AS pearson FROM pairs", PAIRS)
paints("corr_spearman", """SELECT round(corr(rx, ry) + 1e-9, 6) AS spearman FROM (
  SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
         rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM pairs)""", PAIRS)
paints("histogram_bins", f"""SELECT si, lower, upper, n, round(CASE WHEN upper > lower THEN n / ((sum(n) OVER (PARTITION BY si)) * (upper - lower)) END, 9) AS density FROM (
  SELECT si, CASE WHEN b <= 0 THEN CAST(min(p) AS DOUBLE) WHEN b > 30 THEN 30000.0 ELSE (b - 1) * 1000.0 END AS lower,
    CASE WHEN b <= 0 THEN 0.0 WHEN b > 30 THEN CAST(max(p) AS DOUBLE) ELSE b * 1000.0 END AS upper, count(*) AS n FROM (
    SELECT si, {CLAMPED} AS p, CAST(least(greatest(ceil(({CLAMPED}) / 1000.0), 0), 31) AS INTEGER) AS b FROM cohort) GROUP BY si, b)""", COHORT)
SIX = """round(CAST(min({0}) AS DOUBLE) + 1e-9, 6) AS min, round(quantile_cont({0}, 0.25) + 1e-9, 6) AS q1, round(median({0}) + 1e-9, 6) AS median, round(avg({0}) + 1e-9, 6) AS mean,
  round(quantile_cont({0}, 0.75) + 1e-9, 6) AS q3, round(CAST(max({0}) AS DOUBLE) + 1e-9, 6) AS max, count(*) - count({0}) AS missing"""
paints("six_number_summary", f"SELECT version, os, count(sessionrestored) AS n_values, {SIX.format('sessionrestored')} FROM paints GROUP BY version, os")
paints("cohort_summary", f"SELECT si, count(*) AS n_values, {SIX.format('firstpaint')} FROM cohort GROUP BY si", COHORT)
paints("ecdf", f"""SELECT firstpaint, n, round(CAST(sum(n) OVER (ORDER BY firstpaint) AS DOUBLE) / sum(n) OVER () + 1e-9, 6) AS ecdf FROM (
  SELECT {CLAMPED} AS firstpaint, count(*) AS n FROM cohort WHERE si = 0 GROUP BY 1)""", COHORT)
paints("kernel_density", """SELECT i, round(x, 4) AS x, round(y0 + (y1 - y0) * (spot - lft), 10) AS density FROM (
  SELECT p.*, l.y AS y0, r.y AS y1 FROM (
    SELECT CAST(i AS INTEGER) AS i, lo0 + i * (hi0 - lo0) / 511 AS x, (lo0 + i * (hi0 - lo0) / 511 - lo) / delta AS spot,
      least(CAST(floor((lo0 + i * (hi0 - lo0) / 511 - lo) / delta) AS INTEGER), 510) AS lft FROM grid, range(512) g(i)) p
  JOIN smooth l ON l.j = p.lft JOIN smooth r ON r.j = p.lft + 1)""", COHORT,
       """spread AS (SELECT count(*) AS n, min(firstpaint) AS mn, max(firstpaint) AS mx,
         0.9 * least(stddev_samp(firstpaint), (quantile_cont(firstpaint, 0.75) - quantile_cont(firstpaint, 0.25)) / 1.34) * pow(count(*), -0.2) AS bw
         FROM cohort WHERE si = 0)""",
       "limits AS (SELECT *, mn - 3 * bw AS lo0, mx + 3 * bw AS hi0 FROM spread)",
       "grid AS (SELECT *, lo0 - 4 * bw AS lo, (hi0 - lo0 + 8 * bw) / 511 AS delta FROM limits)",
       """cells AS (SELECT c, sum(w) AS w FROM (
         SELECT CAST(floor(pos) AS INTEGER) AS c, 1 - (pos - floor(pos)) AS w FROM (SELECT (firstpaint - lo) / delta AS pos FROM cohort, grid WHERE si = 0)
         UNION ALL SELECT CAST(floor(pos) AS INTEGER) + 1, pos - floor(pos) FROM (SELECT (firstpaint - lo) / delta AS pos FROM cohort, grid WHERE si = 0)) GROUP BY c)""",
       """smooth AS (SELECT j, sum(w * exp(-0.5 * pow((j - c) * delta / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS y
         FROM cells, grid, range(512) g(j) GROUP BY j)""")
oracle("submission_trend", f"""SELECT {DATE}, product_version AS version, CAST(split_part(product_version, '.', 1) AS INTEGER) AS version_major, count,
  round(avg_size / 1024 + 1e-9, 6) AS avg_size_kb, round(sum_size / (1024.0 * 1024 * 1024), 9) AS sum_size_gb FROM by_product
  WHERE product = '{DESKTOP}' AND product_version IN ('16.0', '18.0.1', '9.0')""", TEXT, BY_PRODUCT)
SECOND = f"pairs AS (SELECT firstpaint AS x, ndco AS y FROM paints WHERE {RELEASE} AND firstpaint IS NOT NULL AND ndco IS NOT NULL)"
paints("corr_second_pair", """SELECT 'pearson' AS method, round(corr(x, y) + 1e-9, 6) AS value FROM pairs UNION ALL
  SELECT 'spearman', round(corr(rx, ry) + 1e-9, 6) FROM (
    SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
           rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM pairs)""", SECOND)
paints("late_paint_bins", """SELECT lower, upper, n, round(CASE WHEN upper > lower THEN n / ((sum(n) OVER ()) * (upper - lower)) END, 12) AS density FROM (
  SELECT CASE WHEN b <= 0 THEN CAST(min(p) AS DOUBLE) WHEN b > 108 THEN 600000.0 ELSE 60000 + (b - 1) * 5000.0 END AS lower,
    CASE WHEN b <= 0 THEN 60000.0 WHEN b > 108 THEN CAST(max(p) AS DOUBLE) ELSE 60000 + b * 5000.0 END AS upper, count(*) AS n FROM (
    SELECT p, CAST(least(greatest(ceil((p - 60000) / 5000.0), 0), 109) AS INTEGER) AS b FROM (
      SELECT CASE WHEN firstpaint > 600000 THEN 605000 ELSE firstpaint END AS p FROM paints
      WHERE version = '10.0a1' AND os = 'WINNT' AND firstpaint IS NOT NULL AND ndco IS NOT NULL)) GROUP BY b)""")
paints("cohort_restored_summary", f"SELECT si, count(sessionrestored) AS n_values, {SIX.format('sessionrestored')} FROM cohort GROUP BY si", COHORT)
for _name in ("saved_ping_files", "saved_ping_lines"):
    oracle(_name, "SELECT 'dummy' AS k, md5(json) AS digest FROM stored WHERE json IS NOT NULL", TEXT)

for _name, _same in {"variant_select_fields": "select_fields", "variant_single_histogram": "single_histogram", "variant_adhoc_query": "adhoc_query",
                     "slowsql_rows_sql": "slowsql_rows", "os_version_sql": "os_version_normalize", "buckets_sql": "bucket_generic"}.items():
    ORACLES[_name] = ORACLES[_same]
