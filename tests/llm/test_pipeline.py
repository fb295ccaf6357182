"""Every stage of the pipeline against brute force on its own input, and the guard of the entry."""

import os
import re
import subprocess
import sys

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from conftest import ROOT, SF_SMALL  # tests/conftest.py

from .conftest import rows_of
from .test_documents import dedup_brute, near_brute


@pytest.fixture(scope="module")
def staged(spark):
    """[(name, input, output)] of the stages over the small fixture."""
    from adfeat.sources.staging import stage, staging_scope

    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    with staging_scope(spark):
        for name, f in corpus_pipeline.STAGES:
            done = stage(f(spark, docs, SF_SMALL), f"test-{name}")
            out.append((name, docs, done))
            docs = done
        yield out


def test_all_but_the_last_return_the_columns_of_documents(staged):
    for _, docs, out in staged[:-1]:
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_language_stage(staged):
    _, docs, out = staged[0]
    assert rows_of(out.exceptAll(docs)) == []
    gone = {r.doc_id for r in docs.select("doc_id").exceptAll(out.select("doc_id")).collect()}
    letterless = {r.doc_id for r in docs.collect() if not r.text or not any(c.isalpha() for c in r.text)}
    assert letterless <= gone and len(gone) <= len(letterless) + 0.01 * docs.count()


def test_line_stage(staged):
    _, docs, out = staged[1]
    want = [(d, t) for d, t, _, _ in dedup_brute([(r.doc_id, r.text) for r in docs.collect()])]
    assert rows_of(out.select("doc_id", "text")) == sorted(want, key=repr)
    assert out.where("n_chars <> length(text)").count() == 0


def test_near_stage(staged):
    _, docs, out = staged[2]
    kept = {d for d, (_, _, k) in near_brute([(r.doc_id, r.text) for r in docs.collect()]).items() if k}
    assert {r.doc_id for r in out.collect()} == kept and out.exceptAll(docs).count() == 0


def test_mixing_stage(spark, staged):
    from adfeat.llm.mixing import mix

    _, docs, out = staged[3]
    copies = {r.doc_id: r.copies for r in mix(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == copies
    assert out.distinct().exceptAll(docs).count() == 0


def test_packing_stage(staged):
    from tokenizers import Tokenizer

    _, docs, out = staged[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = sum(len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    pdf = out.toPandas()
    assert pdf.length.sum() == n
    for _, g in pdf.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == np.r_[0, np.cumsum(g.length)][:-1].tolist() and g.length.sum() <= 1024


def test_run_is_the_stages_in_order(spark, staged):
    assert corpus_pipeline.run(spark, SF_SMALL).drop("sequence_id", "offset").exceptAll(staged[-1][2].drop("sequence_id", "offset")).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_take_edge_rows_and_none(spark, edges, nothing, clashing, stage):
    f = stage[1]
    assert f(spark, nothing, SF_SMALL).count() == 0
    a, b = f(spark, edges, SF_SMALL), f(spark, clashing, SF_SMALL)
    last = stage is corpus_pipeline.STAGES[-1]
    cols = [c for c in (a.columns if last else edges.columns) if c not in ("sequence_id", "offset")]
    assert rows_of(a.select(*cols)) == rows_of(b.select(*cols))
    if not last:
        assert a.columns == edges.columns and b.columns == clashing.columns


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the library without the llm folders still imports and has its other queries."""
    import shutil

    root = tmp_path / "copy"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    code = "import __spark_entry__ as e; q = set(e.queries()); assert len(q) > 50 and not any(re.match('op[0-9]|pipeline', x) for x in q | set(e.oracle_sql()))"
    subprocess.run([sys.executable, "-c", "import re; " + code], cwd=root, check=True, env={**os.environ, "PYTHONPATH": ""})


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "adfeat")):
        for name in files:
            path = os.path.join(folder, name)
            if name.endswith(".py") and f"{os.sep}llm" not in folder:
                assert not re.search(r"adfeat\.llm|corpus_pipeline", open(path, encoding="utf-8").read()), path
