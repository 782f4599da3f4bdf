"""Small tables with every awkward case, made from the test session."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["row", "name", "key", "size", "chunk", "role", "_range", "block", "times", "repeat", "part", "target"]
WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from which one had her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three".split()


def texts(n: int, seed: int = 7) -> list[str]:
    """Texts of 1 to 300 words; every fifth is a copy or a near copy of the one before."""
    rule, out = random.Random(seed), []
    for i in range(n):
        words = rule.choices(WORDS, k=rule.choice([1, 3, 8, 30, 80, 300]))
        if i % 5 == 4:
            words = out[-1].split(" ")
            if i % 10 == 9 and len(words) > 40:
                words[rule.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    return out


def rows(n: int = 120) -> list[tuple]:
    made = [(100 + i, t, "en", f"s{i % 4}" if i % 3 else "s0", len(t)) for i, t in enumerate(texts(n))]
    odd = [
        (1, None, "en", None, None), (2, "", "en", "b", 0), (3, " \t\n\r\x0b\x0c", "en", "b", 6), (4, "a b c", "en", "a", 5), (4, "a b c", "en", "a", 5),
        (5, "a  b\tc", None, "a", 6), (None, "x y z w v u t", "en", "b", 13), (None, None, None, None, None), (6, "lorem Ipsum, dolor. " * 8000, "la", "long", 0),
        (7, "ünïcödé 😀 Straße ŒUVRE İstanbul K", "de", "ü", 0), (8, "12345 !!! ###", "en", "b", 13), (9, "w" * 70_000, "en", "b", 0), (10, "abc", "en", "a", 3),
    ]
    return made + odd


def frame(spark: SparkSession, data: list[tuple]) -> DataFrame:
    return spark.createDataFrame(data, SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("own") for c in CLASHING})
