"""A training-data pipeline over the documents table: five stages, each one of the operators.

language ID -> line dedup -> MinHash near-dedup -> mixing to target weights -> best-fit
packing.  Every stage reads the documents that its predecessor kept (a written table) and all
but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adfeat.llm.common import read_table
from adfeat.llm.language import UNKNOWN, annotate, fit
from adfeat.llm.line_dedup import dedup_lines
from adfeat.llm.mixing import mix, seed
from adfeat.llm.near_dup import near_duplicates
from adfeat.llm.packing import pack_documents
from adfeat.sources.staging import stage

#: A document whose language is less certain than this is rejected, as is one without a letter.
LEAST_SCORE = 0.3


#: Columns that the operators read; any other column of the documents is set aside under a name of no operator.
READ = ("doc_id", "text", "lang", "n_chars")


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """(documents whose other columns have names that no operator uses, the columns that bring them back)."""
    names = [n if n in READ else f"own {i}" for i, n in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(f"`{a}`").alias(n) for a, n in zip(names, docs.columns, strict=True)]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known: a letter, and a score of LEAST_SCORE or more."""
    plain, own = _aside(docs)
    return annotate(plain, fit(plain)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*own)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines; every document stays, with the length of what is left."""
    plain, own = _aside(docs)
    return dedup_lines(plain).withColumn("n_chars", F.length("text").cast("long")).select(*own)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, the one with the smallest id (and all without an id)."""
    ids = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as its rate says; documents of a rate below 1 may go."""
    plain, own = _aside(docs)
    copies = mix(docs, read_table(spark, sf_dir, "labels")).groupBy("seed").agg(F.max("copies").alias("_copies"))
    out = plain.withColumn("seed", seed(F.col("doc_id"), F.col("text"))).join(copies.where("_copies > 0"), "seed")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(*own)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens in sequences of 1024."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), size=1024, end_id=2)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("minhash_forest", near_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: No SQL: the language network, the mixing rates and the packing are not SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over documents; what a stage returns is written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage_of in STAGES[:-1]:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
