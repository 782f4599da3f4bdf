from __future__ import annotations

import json

from pyspark.sql import functions as F

from fieldlens.operators import hangs
from fieldlens.schema import SYMBOL_DDL
from tests.test_histograms import frame

V2 = {"memoryMap": [["lib.dll", 2, "{ab-cd}", "lib.pdb"]], "stacks": [[[0, 15], [-1, 7]]], "durations": [3]}
V3 = {"memoryMap": [["lib.pdb", "ABCD2"], ["other.pdb", "X1"]], "stacks": [[[0, 9], [1, 100], [0, 10]], [[0, 25]]]}


def symbols(spark):
    return spark.createDataFrame(
        [("lib.pdb", "ABCD2", 10, "first"), ("lib.pdb", "ABCD2", 20, "second"), ("other.pdb", "X1", 50, "third")], SYMBOL_DDL
    )


def keyed(spark, *documents):
    rows = frame(spark, *documents)
    return rows.withColumn("k", F.concat(F.lit("a20240101"), F.rpad("k", 36, "-")))


def test_only_documents_with_a_memory_map(spark):
    found = hangs.select_hangs(frame(
        spark, {"chromeHangs": V2}, {"chromeHangs": []}, {"chromeHangs": {"memoryMap": []}}, {"chromeHangs": [{"stack": [[0, 1]]}]},
        {"lateWrites": V3}, {"chromeHangs": None}, "{", None, {"chromeHangs": [], "lateWrites": V3},
    ))
    assert sorted(r.k for r in found.collect()) == ["k0", "k4", "k8"]


def test_frames_of_both_layouts(spark):
    parsed = hangs.select_hangs(frame(spark, {"chromeHangs": V2, "lateWrites": V3}))
    rows = {(r.kind, r.stack_no, r.frame_no): (r.module, r.debug_id, r.offset) for r in hangs.frames(parsed).collect()}
    assert rows == {
        ("hang", 0, 0): ("lib.pdb", "ABCD2", 15), ("hang", 0, 1): (None, None, 7),
        ("late_write", 0, 0): ("lib.pdb", "ABCD2", 9), ("late_write", 0, 1): ("other.pdb", "X1", 100),
        ("late_write", 0, 2): ("lib.pdb", "ABCD2", 10), ("late_write", 1, 0): ("lib.pdb", "ABCD2", 25),
    }


def test_listed_stacks_have_no_modules(spark):
    document = {"chromeHangs": [{"stack": [[0, 5]]}], "lateWrites": V3}
    rows = hangs.frames(hangs.select_hangs(frame(spark, document))).where("kind = 'hang'").collect()
    assert [(r.stack_no, r.frame_no, r.module, r.offset) for r in rows] == [(0, 0, None, 5)]


def test_report(spark):
    document = {"chromeHangs": V2, "lateWrites": V3, "histograms": {"A": {}}, "info": {"appName": "P"}, "ver": 1}
    empty = {"chromeHangs": {"memoryMap": [["lib.pdb", "ABCD2"]], "stacks": []}}
    out = {json.loads(r.metadata).get("ver"): r for r in hangs.hang_report(keyed(spark, document, empty), symbols(spark)).collect()}
    full = out[1]
    assert json.loads(full.metadata) == {"info": {"appName": "P"}, "ver": 1}
    assert (full.lookups, full.errors, full.d) == (2, 0, "20240101")
    assert full.hang_stacks == ["first\n0x7"]
    assert full.late_write_stacks == ["0x9\nthird\nfirst", "second"]
    assert (out[None].lookups, out[None].errors, out[None].hang_stacks) == (1, 1, [])
    text = hangs.as_text_report(hangs.hang_report(keyed(spark, document), symbols(spark))).first().value
    assert text.endswith("----- BEGIN LATE WRITE STACK -----\nsecond\n----- END LATE WRITE STACK -----\n")
    assert text.startswith("20240101\tk0---") and "----- BEGIN HANG STACK -----\nfirst\n0x7\n----- END HANG" in text
