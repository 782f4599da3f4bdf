from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from fieldlens.llm import exact_dedup
from tests.llm import samples


def wanted(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for content, members in groups.items():
        best = sorted(members)
        out += [(m[3], best[0][3], len(best), hashlib.sha256(content.encode()).hexdigest()) for m in best]
    return sorted(out, key=str), len(groups)


def test_groups_equal_a_plain_version(spark):
    rows = samples.rows()
    docs = samples.clashing(samples.frame(spark, rows))
    expected, groups = wanted(rows)
    for key in (F.xxhash64, lambda c: F.length(c).cast("long")):  # the second makes most blocks share a key
        found = exact_dedup.exact_groups(docs, block=16 if key is F.xxhash64 else 2000, key=key).collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=str) == expected
        assert sum(r.kept for r in found) == groups


def test_deduplicate_keeps_whole_rows(spark):
    docs = samples.clashing(samples.frame(spark, samples.rows()))
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    assert kept.count() == wanted(samples.rows())[1]
    assert kept.where("doc_id = 4").count() == 0 and kept.where("doc_id = 5").count() == 1


def test_empty_table(spark):
    assert exact_dedup.exact_groups(samples.frame(spark, [])).collect() == []
