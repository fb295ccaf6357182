"""Hot lines, many ids, rare languages, ids with two labels, columns of any name, an absent package."""

import os
import subprocess
import sys
import zlib

import corpus_pipeline
import pytest
from conftest import ROOT, SF_SMALL  # tests/conftest.py
from pyspark.sql import functions as F

from adfeat.llm import language, line_dedup, mixing, near_dup

from .conftest import CLASHES, rows_of


def test_a_hot_line_is_asked_about_in_several_groups(spark, small_docs):
    line = "\nthis one line is in every document of the table"
    docs = small_docs.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(line))).repartition(6)
    want = rows_of(line_dedup.dedup_lines(docs))
    assert rows_of(line_dedup.dedup_lines(docs, questions=3)) == want


def test_many_ids_take_the_join(spark, small_docs):
    assert rows_of(near_dup.near_duplicates(small_docs, filter_ids=0)) == rows_of(near_dup.near_duplicates(small_docs))


def test_a_rare_language_is_in_the_sample(spark):
    common = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the words of row "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    learned = next(i for i in range(5001, 5100) if zlib.crc32(str(i).encode()) % 4 != 2)
    rare = spark.createDataFrame([(learned, "слова этой строки", "ru")], "doc_id long, text string, lang string")
    windows, labels = language.sample_windows(common.unionByName(rare), rows=100)
    assert labels.count("ru") >= 1 and 1 <= labels.count("en") <= 50 * language.ROW_WINDOWS
    assert (windows, labels) == language.sample_windows(common.unionByName(rare).repartition(7), rows=100)


def test_an_id_with_two_labels_has_the_domain_listed_first(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} again word{i % 3}") for i in range(12)], "doc_id long, text string")
    labels = [(i, i % 2, 0) for i in range(12)]
    plain = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    twice = spark.createDataFrame(labels + [(i, 0, 1) for i in range(12)], "doc_id long, quality int, toxic int")
    want = mixing.classifier(docs, plain, mixing.DOMAINS)
    assert mixing.classifier(docs, twice, mixing.DOMAINS) == want == mixing.classifier(docs, twice.repartition(5), mixing.DOMAINS)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_of_any_name(spark, small_docs, stage):
    docs = small_docs.select("*", *[F.concat(F.lit("own"), F.col("doc_id")).alias(c) for c in CLASHES])
    out = stage[1](spark, docs, SF_SMALL)
    assert out.columns == docs.columns and out.count()
    assert out.where(" OR ".join(f"`{c}` IS NULL OR `{c}` <> concat('own', doc_id)" for c in CLASHES)).count() == 0


def test_entry_works_without_a_package_that_only_the_operators_need():
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = set(e.queries()); assert len(q) > 50 and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, env={**os.environ, "PYTHONPATH": ""})
