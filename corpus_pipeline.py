"""A corpus from raw documents: language, exact and near copies, source weights, packed sequences."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import exact_dedup, language, mixing, packing, simhash
from fieldlens.llm.common import documents, small_batches
from fieldlens.session import Scope, stage

_open: list[Scope] = []


def step(function):
    """A stage; its intermediate tables go when the next stage begins, as its result is written by then."""
    @functools.wraps(function)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _open:
            _open.pop().drop()
        small_batches(spark)
        with Scope(spark) as scope:
            _open.append(scope)
            return function(spark, docs, sf_dir)

    return run_step


@step
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones of ``docs`` teach; those without letters go."""
    return language.accepted(docs, language.fit(docs))


@step
def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of those that are equal up to white space."""
    return exact_dedup.deduplicate(docs)


@step
def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return simhash.one_per_group(docs)


@step
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the source weights ask for; some repeat, some go."""
    return mixing.mix(docs)


@step
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in token sequences; a document that the mix repeats is packed each time."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language), ("exact dedup", no_exact_copies), ("near dedup", no_near_copies),
    ("source mix", mixed_sources), ("packing", packed),
]

#: SimHash and packing have no SQL form; the tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
