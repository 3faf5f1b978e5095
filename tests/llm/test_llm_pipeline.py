"""The pipeline's stages on their own inputs, the registered queries, and the native plans."""

from __future__ import annotations

import llm_brute as brute
import corpus_pipeline
import pytest
from llm_rows import ODD
from pyspark.sql import functions as F

import __spark_entry__ as entry
from findlark.llm import decontaminate, langid, pii, quality
from findlark.llm.queries import QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_take_odd_rows(spark, sf_dir, odd, empty, stage):
    assert stage(spark, odd, sf_dir).columns == odd.columns
    assert stage(spark, empty, sf_dir).count() == 0
    assert set(stage(spark, odd, sf_dir).toPandas().doc_id.dropna()) <= {i for i, _ in ODD if i is not None}


CLASHING = ["score", "lang_pred", "text_key", "_key", "_id", "_doc", "_n", "_size", "more", "_m", "_same", "hash", "a.b"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_leave_other_columns_alone(spark, sf_dir, docs, stage):
    """Columns called like those operators use inside come back with their values."""
    clashing = docs.select("*", *[(F.col("doc_id") * 10 + k).alias(name) for k, name in enumerate(CLASHING)])
    plain = {r.doc_id: r for r in stage(spark, docs, sf_dir).collect()}
    rows = stage(spark, clashing, sf_dir)
    assert rows.columns[: len(clashing.columns)] == clashing.columns
    found = {r.doc_id: r for r in rows.collect()}
    assert set(found) == set(plain)
    for i, row in found.items():
        assert [row[name] for name in CLASHING] == [i * 10 + k for k in range(len(CLASHING))]
        assert all(row[name] == plain[i][name] for name in plain[i].asDict())


def test_language_stage(spark, sf_dir, docs, make):
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, sf_dir).collect()}
    rejected = docs.where(~F.col("doc_id").isin(kept))
    # every prose document has letters of a learned language
    assert rejected.where(F.regexp_like("text", F.lit(r"\p{L}{20}"))).isEmpty()
    rows = make([(1, "12 34"), (2, None), (3, "hello there")])
    assert [r.doc_id for r in corpus_pipeline.language(spark, rows, sf_dir).collect()] == [3]


def test_line_stage(spark, sf_dir, docs, texts):
    found = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.repeated_lines(spark, docs, sf_dir).collect()}
    expected = dict(brute.line_dedup(list(texts.items())))
    expected = {i: t for i, t in expected.items() if t == texts[i] or brute.words(t)}
    assert {i: t for i, (t, _) in found.items()} == expected
    assert all(n == len(t) for t, n in found.values())


def test_near_duplicate_stage(spark, sf_dir, docs, texts):
    found = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()}
    assert found == {c for _, _, c in brute.simhash(list(texts.items()))}


def test_benchmark_stage(spark, sf_dir, docs):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = {r.doc_id for r in decontaminate.leaks(docs, benchmark).collect()}
    found = {r.doc_id for r in corpus_pipeline.benchmarks(spark, docs, sf_dir).collect()}
    assert found == {r.doc_id for r in docs.collect()} - held and held


def test_mixing_stage(spark, sf_dir, docs, odd, empty):
    rows = corpus_pipeline.mixed(spark, docs, sf_dir)
    assert rows.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    found = rows.collect()
    whole = docs.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert sum(r.taken for r in found) == int(1.5 * whole) and all(r.taken > 0 for r in found)
    again = corpus_pipeline.mixed(spark, docs.repartition(3, "text"), sf_dir)
    assert sorted(again.collect()) == sorted(found)
    assert corpus_pipeline.mixed(spark, odd, sf_dir).where("doc_id = 7").count() <= 2
    assert corpus_pipeline.mixed(spark, empty, sf_dir).count() == 0


def test_run_is_the_stages_in_turn(spark, sf_dir, docs):
    rows = docs
    for _, stage in corpus_pipeline.STAGES:
        rows = spark.createDataFrame(stage(spark, rows, sf_dir).toPandas(), stage(spark, rows, sf_dir).schema)
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(rows.collect())


def test_native_operators_have_no_python(docs, spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for frame in (pii.personal_data(docs), quality.judge(docs), decontaminate.leaks(docs, benchmark)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_learning_leaves_held_out_documents_alone(spark, docs):
    changed = docs.withColumn("text", F.when(langid.is_held_out(), F.lit("zzz qqq")).otherwise(F.col("text")))
    one, other = langid.learn(docs), langid.learn(changed)
    assert set(one) == set(other) and all((one[k] == other[k]).all() for k in one)
