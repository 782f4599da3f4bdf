"""Names, types and fixed values shared by all modules."""

# Ten descriptive dimensions of a submission, in report order.
DIMENSIONS = [
    "d", "reason", "product", "product_version", "product_channel",
    "arch", "os", "os_version", "app_build_id", "plat_build_id",
]
DIMS_VALID = DIMENSIONS + ["is_valid"]
DIMS_NAME = DIMS_VALID + ["hist_name"]
DIMS_VALUE = DIMS_NAME + ["v"]

# Submission field behind each dimension that is read from the ``info`` object.
INFO_FIELDS = {
    "reason": "reason",
    "product": "appName",
    "product_version": "appVersion",
    "product_channel": "appUpdateChannel",
    "arch": "arch",
    "os": "OS",
    "os_version": "version",
    "app_build_id": "appBuildID",
    "plat_build_id": "platformBuildID",
}

DEFAULT_REASONS = ("idle-daily", "saved-session")
PRERELEASE_CHANNELS = ("nightly", "aurora", "beta")
RELEASE_CHANNEL = "release"
MISSING = "NA"

# Key layout: one salt character, the day as yyyyMMdd, a 36-character UUID.
SALT_LENGTH, DAY_LENGTH, UUID_LENGTH = 1, 8, 36

# Prefix of histogram names made from simple measurements.
MEASURE_PREFIX = "SIMPLE_MEASURES_"

# Open-core layout of one histogram: leaves stay VARIANT so that their JSON type is known.
HISTOGRAM_DDL = (
    "struct<values: map<string, variant>, sum: variant, bucket_count: variant, "
    "`range`: variant, histogram_type: variant, valid: variant>"
)
VARIANT_MAP_DDL = "map<string, variant>"

# Top-level parts of a submission and how they are read. Members stay VARIANT, so that one member of
# an unexpected type costs only that member.
PART_TYPES = {
    "info": "variant",
    "histograms": VARIANT_MAP_DDL,
    "simpleMeasurements": VARIANT_MAP_DDL,
    "slowSQL": "struct<mainThread: map<string, variant>, otherThreads: map<string, variant>>",
    "chromeHangs": "variant",
    "lateWrites": "variant",
    "payload": "string",
}
# Read a part only to see that it is an object.
PRESENT_DDL = "struct<`_present`: string>"

# Fixed metadata of simple measurements: bucket count, lower range, upper range, type.
MEASURE_LAYOUT = {
    "uptime": (30, 0, 2880, 0),
    "startupInterrupted": (2, 0, 1, 2),
    "startupCrashDetectionEnd": (30, 30000, 90000, 1),
    "savedPings": (51, 0, 50, 0),
}
OTHER_MEASURE_LAYOUT = (31, 0, 30001, 1)
NESTED_MEASURE_LAYOUT = (2, 0, 1, 2)

# Step between bucket edges of measures on a regular grid.
MEASURE_STEP = {"startupCrashDetectionEnd": 2000, "savedPings": 1}
OTHER_MEASURE_STEP = 1000

# Quantiles of the slow SQL report: column -> (numerator, denominator).
SLOW_SQL_QUANTILES = {
    "q0": (0, 1), "q25": (1, 4), "q50": (1, 2), "q75": (3, 4), "q95": (19, 20), "q100": (1, 1),
}

# Fixed values: ``info`` fields that make up a configuration fingerprint, in order.
FINGERPRINT_FIELDS = [
    "reason", "OS", "appID", "appBuildID", "appName", "platformBuildID", "appUpdateChannel",
    "locale", "cpucount", "arch", "version", "device", "hardware",
    "hasMMX", "hasSSE", "hasSSE2", "hasSSE3", "hasSSE4A", "hasSSSE3", "hasSSE4_1", "hasSSE4_2",
    "hasEDSP", "hasARMv6", "hasARMv7",
    "adapterDescription", "adapterVendorID", "adapterDeviceID", "adapterRAM",
    "adapterDriver", "adapterDriverVersion", "adapterDriverDate",
    "DWriteEnabled", "DWriteVersion", "flashVersion",
]

SUBMISSION_DDL = "k string, d string, json string"
SPEC_DDL = (
    "version_key string, hist_name string, min string, max string, hist_type string, "
    "bucket_count string, buckets array<int>"
)
SYMBOL_DDL = "module string, debug_id string, start bigint, name string"

# Delimited inputs of the statistics jobs.
CYCLE_COLLECTOR_DDL = (
    "id string, date_str string, version string, os string, hist_name string, hist_value string, "
    "hist_value_count string, hist_sum string"
)
GC_UPTIME_DDL = "key string, date_str string, version string, sum_count double, uptime double"
SLOW_SQL_DDL = "sql string, count string, time string"
SUBMISSION_STATS_DDL = (
    "date_str string, product string, version string, count bigint, sum_size bigint, avg_size double"
)
