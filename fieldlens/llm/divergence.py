"""How far the sources of a language differ: exact term counts by CountVectorizer, compared source by source.

One CountVectorizer serves all languages: a term carries its language in front, so the vocabularies never mix, the
least document frequency counts documents of that language alone, and no language needs a pass of its own. With the
greatest vocabulary size nothing is cut. The sparse vectors are summed by group as their (index, count) entries,
never as dense vectors, and counts stay whole numbers.

Shares of sources are compared in blocks of a language's terms. A block gets the terms' counts as sparse rows and
every source's share of an absent term once, and holds about CELLS numbers, or TERMS terms of all sources; its sums
for each pair of sources are added up. The vocabulary is written and read as a table; CountVectorizer itself brings
it to the driver once, which is the terms of at least ``least_docs`` documents, not what the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.session import fresh_path, stage

LEAST_DOCS = 30  # documents of a language that have a kept term
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50  # terms reported of a group
CELLS = 1 << 15  # of a block
TERMS = 256  # of a block of many sources, so that its sums are not many more than its numbers
GREATEST = 2**31 - 1

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
#: A term is a run of letters and of bytes beyond ASCII; all other bytes become blanks.
_LETTER = np.where((_BYTES >= 128) | ((_LOWER >= 97) & (_LOWER <= 122)), _LOWER, 32).astype(np.uint8)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, terms) of (lang, source, text); a term is written behind its language and a colon, which no term has."""
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary())
        data = _LETTER[np.frombuffer(texts.buffers()[2], dtype=np.uint8)] if texts.buffers()[2] else b""
        letters = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(data)], 0, texts.offset)
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(letters))
        found, owner = lists.flatten().cast(pa.string()), pc.list_parent_indices(lists).to_numpy()
        real = pc.greater(pc.binary_length(found), 0)  # a text without letters is one empty part
        found, owner = found.filter(real), owner[real.to_numpy(zero_copy_only=False)]
        named = pc.binary_join_element_wise(batch.column(0).take(pa.array(owner)), found, ":")
        starts = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(starts), named)], names=["lang", "source", "terms"])


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, lang: str = "lang", source: str = "source", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, source) groups, and (lang, source, term, n) for the kept terms that a group has.

    While counts are summed a hash stands for the group; its seed is one under which no two groups meet.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = docs.select(plain(lang).alias("lang"), plain(source).alias("source"), plain(text).alias("text"))
    rows = named.mapInArrow(_terms, "lang string, source string, terms array<string>")
    groups, seed = stage(named.select("lang", "source").distinct(), "groups"), 0
    code = lambda: F.xxhash64("lang", "source", F.lit(seed))
    while groups.groupBy(code()).count().where("count > 1").limit(1).count():
        seed += 1
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least_docs), vocabSize=GREATEST).fit(rows)
    path = fresh_path(docs.sparkSession, "vocabulary")
    model.write().save(path)
    words = docs.sparkSession.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "word"))
    vector = F.unwrap_udt("vector")
    entries = model.transform(rows).select(code().alias("code"), F.inline(F.arrays_zip(vector["indices"].alias("index"), vector["values"].alias("n"))))
    sums = entries.groupBy("code", "index").agg(F.sum(F.col("n").cast("long")).alias("n"))
    counts = sums.join(words, "index").join(groups.withColumn("code", code()), "code")
    return groups, stage(counts.select("lang", "source", F.substring_index("word", ":", -1).alias("term"), "n"), "counts")


def _share(count: Column, total: Column, kept: Column, smoothing: int) -> Column:
    """1 + floor(SCALE * (count + smoothing) / (total + smoothing * kept)), exactly."""
    whole = lambda c: c.cast("decimal(26,0)")
    return F.lit(1) + F.call_function("div", whole(count + smoothing) * F.lit(SCALE).cast("decimal(10,0)"), whole(total + smoothing * kept))


def _compare(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: sums over its terms of the distance of each two sources' shares."""
    lang, spare = rows["lang"].iloc[0], rows["term"].isna()
    sources = rows[spare].sort_values("source", ignore_index=True)
    names = sources["source"].tolist()
    given = rows[~spare]
    code, terms = pd.factorize(given["term"])
    share = np.repeat(sources["p"].to_numpy(dtype=np.int64)[:, None], len(terms), axis=1)
    share[given["source"].map({name: i for i, name in enumerate(names)}).to_numpy(dtype=np.int64), code] = given["p"].to_numpy(dtype=np.int64)
    first, second, value = [], [], []
    for i in range(len(names) - 1):
        value += np.abs(share[i + 1 :] - share[i]).sum(axis=1).tolist()
        first += [names[i]] * (len(names) - i - 1)
        second += names[i + 1 :]
    return pd.DataFrame({"lang": lang, "source": first, "item": second, "value": np.array(value, dtype=np.int64)})


def _pairs(groups: DataFrame, shares: DataFrame, cells: int, terms: int) -> DataFrame:
    """(lang, source, item, value) for each two sources of a language; ``groups`` has sources, kept, absent."""
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("kept") * F.col("sources") / F.greatest(F.lit(cells), F.col("sources") * terms)))
    sized = groups.select("lang", "source", F.col("absent").alias("p"), blocks.alias("blocks"))
    spare = sized.where("p IS NOT NULL").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), "p")
    dealt = shares.join(sized.select("lang", "source", "blocks"), ["lang", "source"])
    dealt = dealt.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "p")
    parts = dealt.unionByName(spare).groupBy("lang", "block").applyInPandas(_compare, "lang string, source string, item string, value long")
    half = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    other = groups.select("lang", F.col("source").alias("item"))
    listed = groups.select("lang", "source").join(other, "lang").where("source <> item")  # as many rows as the result has
    return listed.join(both, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top: int = TOP, cells: int = CELLS, block_terms: int = TERMS,
          lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank of each (lang, source) group.

    Part ``pair``: the distance to each other source of the language, farthest first. Part ``term``: the ``top``
    terms that the group uses more than its language. NULL text, language and source count as empty. Groups
    without terms have the shares of absent terms; a language without kept terms has distance 0 between its
    sources and no terms. A language with one source has no pairs. Equal values rank by item; an empty table
    gives no rows. Other columns are ignored.
    """
    groups, counts = term_counts(docs, least_docs, lang, source, text)
    of_lang = stage(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")), "terms")
    sizes = of_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    known = groups.join(sources, "lang").join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    known = known.select("lang", "source", "sources", F.coalesce("kept", F.lit(0)).alias("kept"), "lang_total", F.coalesce("total", F.lit(0)).alias("total"))
    absent = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"), smoothing))
    known = stage(known.withColumn("absent", absent), "known")
    joined = counts.join(known, ["lang", "source"]).join(of_lang, ["lang", "term"])
    shares = stage(joined.select("lang", "source", "term", _share(F.col("n"), F.col("total"), F.col("kept"), smoothing).alias("p"),
                                 _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), smoothing).alias("q")), "shares")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank"))

    terms = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    pairs = _pairs(known, shares.drop("q"), cells, block_terms)
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
