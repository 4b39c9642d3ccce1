import inspect
import re
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__

from . import test_decontaminate, test_minhash, test_packing, test_quality, test_secrets  # noqa: F401
from .conftest import SF


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}


def test_stages_one_by_one(spark):
    """Each stage against a brute-force view of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        out[name] = before, {r.doc_id: r for r in docs.collect()}

    before, after = out["quality"]
    assert set(after) <= {i for i, t in before.items() if not test_quality.brute(t)[-1]}
    assert all(after[i].text == before[i] for i in after)

    before, after = out["near_duplicates"]
    parts = test_minhash.brute(before.items())
    assert set(after) == {i for i in before if parts[i][1] == i}

    before, after = out["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {i for i, t in before.items() if not any(x in t for x in items)}

    before, after = out["secret_scan"]
    assert set(after) == set(before)
    for i, t in before.items():
        assert not test_secrets.brute(after[i].text)
        assert bool(test_secrets.brute(t)) <= ("[SECRET]" in after[i].text)
        assert after[i].n_chars == len(after[i].text)

    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    by_doc = defaultdict(int)
    for r in pieces:
        by_doc[r.doc_id] += r.length
    assert dict(by_doc) == {i: len(test_packing.whole_ids(r.text)) for i, r in after.items()}


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = sorted(tuple(r[k] for k in key) for r in docs.collect())
    got = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r[k] for k in key) for r in got.collect()) == want


def folder_with(spark, tmp_dir, docs):
    """A table folder whose documents are ``docs``."""
    import os
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    for t in ("benchmark", "labels"):
        os.symlink(f"{SF}/{t}.parquet", f"{tmp_dir}/{t}.parquet")
    return tmp_dir


def test_empty_documents_go_through(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder_with(spark, tmp_dir, docs)).count() == 0


def test_null_and_repeated_ids_and_clashing_columns_go_through(spark, tmp_dir, edge_docs):
    """Every stage takes the edge cases; whole documents come out at the end."""
    docs, rows = edge_docs
    docs = docs.union(docs.limit(40).withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.withColumns({c: F.lit(1.5) for c in ("judged", "pii_k1", "dropped_k1", "order_key")})
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    path = folder_with(spark, tmp_dir, docs)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), name)
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    assert docs.filter("doc_id is null").count() > 0         # rows without id are judged, not lost
    pieces = corpus_pipeline.packing(spark, docs, path)
    want = sorted(str(r.doc_id) for r in docs.collect())
    assert sorted(str(r.doc_id) for r in pieces.filter("start = 0").collect()) == want


def test_nothing_else_imports_the_package():
    import pathlib

    import arenalytics
    root = pathlib.Path(inspect.getfile(arenalytics)).parent
    for f in root.rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\b.*\bllm\b", f.read_text(), re.M), f
