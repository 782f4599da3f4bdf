"""Exact deduplication by deterministic block naming.

The normalised text is cut into blocks of a fixed number of characters. Distinct blocks are sorted
into integer names; adjacent names are then paired and the distinct pairs sorted into names again,
until every document has one name. Two documents have the same name exactly when their normalised
texts are the same: a name stands for a content, never for a hash of it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import SPACE, whole, with_rows
from fieldlens.session import stage

BLOCK_CHARS = 1024


def normalised(text: str) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; NULL counts as empty."""
    return F.regexp_replace(whole(text), SPACE + "+", "")


def _blocks(text: str, block: int) -> Column:
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(pieces)


def _sorted_names(distinct: DataFrame, *keys: str) -> DataFrame:
    """The distinct keys in sorted order with integer names; written, so that names never change."""
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ordered.withColumn("name", F.monotonically_increasing_id()), "names")


def _first_names(texts: DataFrame, row: str, block: int, key: Callable[[Column], Column]) -> DataFrame:
    """(row, pos, name) of every block.

    Only the pass that finds distinct blocks shuffles text, and copies meet before they are shuffled.
    Blocks are sorted by a 64-bit key; where different contents share a key the contents decide.
    """
    blocks = texts.select(row, F.posexplode(_blocks("content", block)).alias("pos", "block"))
    contents = (
        blocks.select(key(F.col("block")).alias("key"), "block").groupBy("key")
        .agg(F.min("block").alias("least"), F.max("block").alias("most"))
    )
    keys = stage(contents.select("key", (F.col("least") < F.col("most")).alias("shared")), "blocks")
    placed = blocks.select(row, "pos", key(F.col("block")).alias("key"), "block")
    names = keys.select("key", F.lit(None).cast("string").alias("block"))
    if keys.where("shared").isEmpty():
        placed = placed.withColumn("block", F.lit(None).cast("string"))
    else:
        placed = placed.join(keys, "key").withColumn("block", F.when(F.col("shared"), F.col("block"))).drop("shared")
        several = placed.where(F.col("block").isNotNull()).select("key", "block").distinct()
        names = names.join(keys.where("shared"), "key", "left_anti").unionByName(several)
    return _named(placed, _sorted_names(names, "key", "block"), row, "key", "block")


def _named(placed: DataFrame, names: DataFrame, row: str, left: str, right: str) -> DataFrame:
    same = (F.col(f"p.{left}") == F.col(f"n.{left}")) & F.col(f"p.{right}").eqNullSafe(F.col(f"n.{right}"))
    return stage(placed.alias("p").join(names.alias("n"), same).select(f"p.{row}", "p.pos", "n.name"), "level")


def identities(texts: DataFrame, row: str, block: int = BLOCK_CHARS, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(row, name) from ``texts`` (row, content): equal names mean equal contents.

    Each round halves the names of the longest document; a last name without a partner is paired with -1.
    """
    level = _first_names(texts, row, block, key)
    most = level.agg(F.max("pos")).first()[0]
    left = 0 if most is None else most + 1
    while left > 1:
        odd = F.col("pos") % 2 == 1
        pairs = stage(
            level.groupBy(row, F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(~odd, F.col("name"))).alias("first"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("second")
            ),
            "pairs",
        )
        level = _named(pairs, _sorted_names(pairs.select("first", "second").distinct(), "first", "second"), row, "first", "second")
        left = (left + 1) // 2
    return level.select(row, "name")


def _decided(rows: DataFrame, row: str, doc_id: str, text: str, block: int, key) -> DataFrame:
    content = stage(rows.select(row, F.col(doc_id).alias("id"), F.length(whole(text)).alias("chars"), normalised(text).alias("content")), "content")
    names = identities(content.select(row, "content"), row, block, key)
    facts = content.select(row, "id", "chars", F.sha2("content", 256).alias("sha"))
    known = stage(facts.join(names, row), "named")
    best = F.min(F.struct(-F.col("chars"), F.col("id").isNull(), "id", row)).alias("best")
    groups = stage(known.groupBy("name").agg(best, F.count("*").alias("members")).select("name", F.col("best.id").alias("keep"), F.col(f"best.{row}").alias("kept_row"), "members"), "groups")
    return known.join(groups, "name").withColumn("kept", F.col(row) == F.col("kept_row"))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK_CHARS, key: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most characters stays, then the smallest id (a NULL id last), then
    any one of rows that agree in both. NULL and empty texts are one group. An empty table gives no
    rows; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    decided = _decided(rows, "row", "doc_id", "text", block, key)
    return decided.select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("members").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, row = with_rows(docs, "documents")
    decided = _decided(rows, row, doc_id, text, block, F.xxhash64)
    return rows.join(decided.where("kept").select(row), row, "left_semi").select(*docs.columns)
