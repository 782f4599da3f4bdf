"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of shuffled documents, repeated as often as the cap allows. An entry's virtual
finish time is the number of its source's words up to its end, divided by the source's target. Entries
are sorted by it over all sources and the sequence is cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.common import WORD, fresh, total_before, whole, with_rows
from fieldlens.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MOST = 2  # times a document may be taken
NEAR = 0.01  # of its target: a source of whole documents that misses it by no more is done


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Adds ``target`` and ``ahead`` (words of the sources before) to (source, source_size).

    Sources in the order of their code points, NULL last, get the weights in turn. They share the budget by
    weight; none gets more than ``most`` times its size, and the excess is shared among the others in the
    same way. So sources fill up in the order of cap / weight, and the others are on one level.
    """
    placed = total_before(sources, [F.col("source").asc_nulls_last()], {"place": F.lit(1), "ahead": F.col("source_size")}, "sources")
    turn = F.array(*[F.lit(w) for w in weights])
    capped = placed.withColumns({"weight": F.get(turn, (F.col("place") % len(weights)).cast("int")), "cap": F.col("source_size") * most})
    ratio = F.col("cap") / F.col("weight")
    filled = stage(total_before(capped, [ratio, F.col("place")], {"full_cap": F.col("cap"), "full_weight": F.col("weight")}, "caps"), "filled")
    size, total_weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(share * (size or 0)) - F.col("full_cap")) / (F.lit(total_weight).cast("long") - F.col("full_weight"))
    common = filled.where(level <= ratio).agg(F.min_by(level, F.struct(ratio, "place"))).first()[0]
    cap = F.col("cap").cast("double")
    target = cap if common is None else F.least(cap, F.col("weight") * F.lit(common))
    return filled.select("source", "source_size", "ahead", target.alias("target"))


def _queues(rows: DataFrame, row: str, doc_id: str, source: str, text: str, weights, share: float, most: int, seed: int) -> DataFrame:
    """One row per input row: its size, its source's target and the words queued before it in its source."""
    shuffled = F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(seed)))
    sized = stage(
        rows.select(row, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), shuffled.alias("shuffled"), F.regexp_count(whole(text), F.lit(WORD)).cast("long").alias("size")),
        "sized",
    )
    targets = stage(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    queued = total_before(sized, [F.col("source").asc_nulls_last(), F.col("shuffled"), F.col(row)], {"before": F.col("size")}, "queued")
    joined = queued.alias("q").join(targets.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source")))
    return stage(joined.select("q.*", "source_size", "target", (F.col("before") - F.col("ahead")).alias("queued")).drop("before"), "queues")


def _entries(queues: DataFrame, row: str, most: int) -> DataFrame:
    """The entries that are taken, with the words that are taken of each and their place in the mix.

    Targets add up to the budget, so the sequence ends at virtual time 1: what finishes by then is
    whole, and of the document that a source has in service the words up to its target are taken.
    """
    times = queues.where("size > 0 AND target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn"))
    before = F.col("turn") * F.col("source_size") + F.col("queued")
    left = F.floor("target") - before
    timed = times.select(
        row, "doc_id", "source", "shuffled", "size", "turn",
        ((before + F.col("size")) / F.col("target")).alias("finish"), F.least(F.col("size"), left).alias("words"),
    ).where("words > 0")
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("turn"), F.col("shuffled"), F.col(row)]
    return total_before(timed, order, {"position": F.col("words")}, "entries")


def taken(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 1) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, first_position.

    ``taken`` counts words with repeats; ``first_position`` is where the document first begins in the
    mix, NULL if it is not taken. A NULL source is a source of its own, a NULL text has no words, repeated
    rows queue one by one, a source without words has target 0, an empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    queues = _queues(rows, "row", "doc_id", "source", "text", weights, share, most, seed)
    mixed = _entries(queues, "row", most).groupBy("row").agg(F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    return queues.join(mixed, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_position")


def _whole_entries(queues: DataFrame, row: str, most: int) -> DataFrame:
    """(row, times): how often each document is taken whole.

    A source's queue is taken as far as its target reaches. The words left over go to later documents that fit:
    in every round those that fit queue again, and are taken as far as the words reach, until none fits or the
    source is within ``NEAR`` of its target. What is left of a target then is no more than that, or less than any
    of the source's remaining documents.
    """
    turns = queues.where("size > 0 AND target > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("turn"))
    end = F.col("turn") * F.col("source_size") + F.col("queued") + F.col("size")
    times = turns.select(row, "source", "shuffled", "size", "turn", end.alias("end"), F.floor("target").alias("budget"))
    inside = F.col("end") <= F.col("budget")
    taken = [times.where(inside).select(row, "source", "size")]
    budgets = times.groupBy("source").agg(F.max("budget").alias("budget"), F.coalesce(F.sum(F.when(inside, F.col("size"))), F.lit(0)).alias("used"))
    left = stage(budgets.select("source", "budget", (F.col("budget") - F.col("used")).alias("left")), "left")
    rest = times.where(~inside).select(row, "source", "shuffled", "size", "turn")
    order = [F.col("source").asc_nulls_last(), F.col("turn"), F.col("shuffled"), F.col(row)]
    while True:
        fitting = stage(rest.alias("r").join(left.alias("l"), F.col("r.source").eqNullSafe(F.col("l.source")))
                        .where((F.col("r.size") <= F.col("l.left")) & (F.col("l.left") > NEAR * F.col("l.budget"))).select("r.*", "budget", "left"), "fitting")
        if fitting.isEmpty():
            break
        placed = stage(total_before(fitting, order, {"before": F.col("size")}, "placed"), "fill")
        starts = placed.groupBy("source").agg(F.min("before").alias("start"))
        joined = placed.alias("p").join(starts.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))).select("p.*", (F.col("before") - F.col("start") + F.col("size")).alias("end"))
        taken.append(joined.where("end <= left").select(row, "source", "size"))
        left = stage(joined.groupBy("source").agg(F.max("budget").alias("budget"), (F.max("left") - F.coalesce(F.sum(F.when(F.col("end") <= F.col("left"), F.col("size"))), F.lit(0))).alias("left")), "left")
        rest = joined.where("end > left").select(row, "source", "shuffled", "size", "turn")
    every = taken[0]
    for part in taken[1:]:
        every = every.unionByName(part)
    return every.groupBy(row).agg(F.count("*").cast("int").alias("times"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 1) -> DataFrame:
    """The mixed documents with all their columns, once for each time that they are taken whole.

    Documents stay in one piece: the one in service at the cut is left out, and its words go to later documents
    of its source that fit, until the source is within ``NEAR`` of its target or none fits.
    """
    rows, row = with_rows(docs, "documents")
    queues = _queues(rows, row, doc_id, source, text, weights, share, most, seed)
    times = fresh(rows, "times")
    joined = rows.join(_whole_entries(queues, row, most).withColumnRenamed("times", times), row)
    repeat = fresh(joined, "repeat")
    return joined.withColumn(repeat, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
