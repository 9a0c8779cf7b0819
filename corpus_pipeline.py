"""From raw documents to packed training sequences, in stages that each write a table.

Each stage takes ``(spark, docs, sf_dir)``, the documents that its predecessor kept, and returns
documents with the same columns; the last one returns the pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orelode.llm.bm25_packing import pack_documents
from orelode.llm.common import staged, table
from orelode.llm.crf_pii import find_personal_data
from orelode.llm.langid import held_out, identify_language
from orelode.llm.ngram_join import ngram_components
from orelode.llm.pareto_mix import mix_sources

#: No SQL: the language model is trained, and components and packing are iterative.
ORACLE_SQL = None

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 80


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; texts without letters go."""
    labelled = F.col("doc_id").isNotNull() & ~held_out()
    found = identify_language(docs, labelled)
    return found.filter(~F.col("rejected")).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of rows that share an id one stays; rows without an id link with nothing and all stay.
    """
    found = ngram_components(docs, width=SHINGLE_WORDS, percent=SIMILARITY_PERCENT)
    first = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id")
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every span of personal data replaced by the name of its kind."""
    found = find_personal_data(docs)
    length = F.coalesce(F.length("masked"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    found = found.withColumn("text", F.col("masked")).withColumn("n_chars", length)
    return found.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = mix_sources(docs).filter(F.col("copies") > 0)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_time")
    return taken.select(*docs.columns, times).drop("_time")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("language_id", identified),
    ("ngram_join", deduplicated),
    ("personal_data", without_personal_data),
    ("source_mix", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
