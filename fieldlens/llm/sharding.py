"""Shards of nearly equal bytes by a minimax contiguous partition.

Rows with equal texts form an atomic group. Groups are ordered by their smallest id; the smallest
capacity for which a greedy pass needs no more than the given number of shards is searched, and the
ordered groups are cut there.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import total_before, whole
from fieldlens.session import stage

SHARDS = 16
POINTS = 50_000  # running totals that the driver asks for at a time


class _Totals:
    """Running totals of the ordered groups, known at some points; what is unknown lies in open gaps."""

    def __init__(self, total: int):
        self.at, self.open = [0, total], [False, True]  # open[i]: unseen totals may lie between at[i - 1] and at[i]

    def least(self, x: int) -> int:
        """The largest running total up to ``x`` that is known."""
        return self.at[bisect_right(self.at, x) - 1]

    def most(self, x: int) -> int:
        """No running total up to ``x`` is larger."""
        i = bisect_right(self.at, x)
        return x if i < len(self.at) and self.open[i] else self.at[i - 1]

    def gaps(self, low: int, high: int) -> list[tuple[int, int]]:
        i = max(1, bisect_right(self.at, low))
        found = []
        while i < len(self.at) and self.at[i - 1] <= high:
            if self.open[i]:
                found.append((self.at[i - 1], self.at[i]))
            i += 1
        return found

    def add(self, gaps: set[tuple[int, int]], buckets: list[tuple[int, int, int]]) -> None:
        """``buckets`` (first, last, how many) hold all totals inside ``gaps``."""
        state = dict(zip(self.at, self.open, strict=True)) | {b: False for _, b in gaps}
        state.update({x: False for bucket in buckets for x in bucket[:2] if x not in state})
        self.at = sorted(state)
        for first, last, n in buckets:
            if n > 2:  # unseen ones may lie anywhere between the first and the last
                for i in range(bisect_right(self.at, first), bisect_right(self.at, last)):
                    state[self.at[i]] = True
        self.open = [state[x] for x in self.at]


def _greedy(capacity: int, shards: int, total: int, before) -> list[int]:
    cuts = [0]
    for _ in range(shards):
        cuts.append(before(min(total, cuts[-1] + capacity)))
    return cuts[1:]


def _search(low: int, high: int, feasible) -> int:
    """The smallest feasible capacity in ``low..high``; ``high`` is taken to be feasible."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int, points: int = POINTS) -> tuple[int, list[int]]:
    """The smallest capacity and the running totals at which to cut.

    ``ends`` has the running totals (``end``) of all groups and stays where it is. The driver knows
    them at a bounded number of points, which bound the capacity from both sides; each round asks for
    points only where the cuts may still lie, until both bounds agree.
    """
    known = _Totals(total)
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    while True:
        reaches = lambda before: lambda c: _greedy(c, shards, total, before)[-1] == total
        high = _search(low, high, reaches(known.least))
        low = _search(low, high, reaches(known.most))
        if low == high and _greedy(high, shards, total, known.least)[-1] == total:
            return high, _greedy(high, shards, total, known.least)
        gaps = {g for a, b in zip(_greedy(low, shards, total, known.least), _greedy(high, shards, total, known.most), strict=True) for g in known.gaps(a, b)}
        spans: list[list[int]] = []
        for a, b in sorted(gaps):
            if spans and spans[-1][1] == a:
                spans[-1][1] = b
            else:
                spans.append([a, b])
        width = max(1, sum(b - a for a, b in gaps) // points)
        within, span = F.lit(False), F.lit(0)
        for a, b in spans:
            within = within | ((F.col("end") > a) & (F.col("end") < b))
            span = span + (F.col("end") > a).cast("int")
        found = ends.where(within).groupBy(span, F.floor(F.col("end") / width)).agg(F.min("end"), F.max("end"), F.count("*")).collect()
        known.add(gaps, [tuple(r)[2:] for r in found])


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1. The law is ``bytes``: no contiguous partition of the ordered
    groups has a smaller largest shard; a group is never split, even if it alone exceeds an equal
    share. NULL texts count as empty ones and share their group. Groups without any id come first.
    Repeated rows take slots of their own. An empty table gives no rows, and other columns are ignored.
    """
    value = whole(text)
    rows = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"), F.sha2(value, 256).alias("content"),
        ),
        "rows",
    )
    groups = stage(rows.groupBy("content").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first")), "groups")
    ordered = total_before(groups, [F.col("first").asc_nulls_first(), F.col("content")], {"before": F.col("bytes")}, "ordered")
    ordered = stage(ordered.withColumn("end", F.col("before") + F.col("bytes")), "ends")
    total, largest = ordered.agg(F.coalesce(F.max("end"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    _, cuts = minimax_cuts(ordered.select("end"), total, largest, shards) if total else (0, [])
    number = F.lit(0)
    for cut in cuts[: shards - 1]:
        number = number + (F.col("end") > cut).cast("int")
    placed = rows.join(ordered.select("content", "end", number.alias("shard")), "content").select("row", "doc_id", "size", "text_crc32", "shard", "end")
    placed = stage(placed, "placed")
    order = [F.col("end"), F.col("doc_id").asc_nulls_first(), F.col("row")]
    counted = total_before(placed, order, {"index": F.lit(1)}, "slots")
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard").count()  # one row per shard
    first = counts.select("shard", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("start"))
    return counted.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("index") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
