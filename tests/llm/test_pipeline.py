from __future__ import annotations

import re
from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from fieldlens.llm.queries import ORACLES, REGISTRY
from tests.compare import connect, difference
from tests.llm import samples
from tests.llm.test_similar import groups, jaccard, shingles

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert set(REGISTRY) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SF_DIR), SF_DIR, REGISTRY[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(ORACLES)))
def test_query_covers_the_table(spark, name):
    wanted = Counter(r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
    found = Counter(r[0] for r in REGISTRY[name](spark, SF_DIR).select("doc_id").collect())
    assert set(found) == set(wanted) and (name == "op3_packing" or found == wanted)


def test_stages(spark):
    """Every stage against plain versions of what it may drop."""
    rows = samples.rows(80)
    docs = samples.frame(spark, rows)
    seen = []
    for name, function in corpus_pipeline.STAGES:
        docs = spark.createDataFrame([tuple(r) for r in function(spark, docs, SF_DIR).collect()], docs.schema if name != "packing" else "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
        seen.append(docs.collect())
    language, exact, near, mixed, packed = seen
    assert {str(r.doc_id) for r in language} >= {str(r[0]) for r in rows if re.search(r"[^\W\d_]", r[1] or "") and r[0] not in (7, 9)}
    assert not {1, 2, 3, 8} & {r.doc_id for r in language}
    plain = {re.sub(r"\s", "", r.text) for r in language}
    assert {re.sub(r"\s", "", r.text) for r in exact} == plain and len(exact) == len(plain)
    assert {r.text for r in near} <= {r.text for r in exact}
    assert len(near) == len(set(groups([r.text for r in exact])))
    assert any(jaccard(shingles(a.text), shingles(b.text)) >= 0.8 for a in exact for b in exact if a.doc_id != b.doc_id)
    assert not any(jaccard(shingles(a.text), shingles(b.text)) >= 0.8 for a in near for b in near if a.doc_id != b.doc_id)
    assert {r.text for r in mixed} <= {r.text for r in near} and max(Counter(r.text for r in mixed).values()) <= 2
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)


def test_run_on_the_smallest_table(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
