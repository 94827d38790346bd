"""The pipeline on awkward tables: nulls, empty texts, repeats, no rows, other columns; toxicity with few labels."""

import pytest

import corpus_pipeline
from ledgerlift.llm.toxicity import toxicity_scores
from pyspark.sql import functions as F

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, tid string, label int, block int, no_text boolean"


def tables(spark, folder, docs, labels=(), items=()):
    spark.createDataFrame([(i, t, "en", "s", 0, "x", 1, 2, None) for i, t in docs], DDL).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def words(tag, n):
    return " ".join(f"{tag}word{i}" for i in range(n))


def test_awkward_rows(spark, tmp_path):
    docs = [(1, words("a", 30)), (2, words("a", 30)), (3, None), (4, ""), (None, words("b", 12)), (5, "short"), (5, words("c", 9)), (6, "  \n\t "), (6, "  \n\t ")]
    got = corpus_pipeline.run(spark, tables(spark, tmp_path, docs, [(1, 1, None), (None, 1, 1)], [(1, None), (2, "")])).collect()
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got)
    assert (False, 1, words("a", 30)) in texts and not any(i == 2 for _, i, _ in texts)  # copies: the least id stays
    assert (True, 0, words("b", 12)) in texts and (False, 5, "short") in texts and (False, 5, words("c", 9)) in texts
    assert [(i, t) for _, i, t in texts if not t.strip()] == [(3, ""), (6, "  \n\t ")]  # a null text leaves as an empty one
    assert {r.n_tokens for r in got if r.text == ""} == {0}


def test_no_rows(spark, tmp_path):
    out = corpus_pipeline.run(spark, tables(spark, tmp_path, []))
    assert out.columns == ["doc_id", "n_tokens", "ids", "text"] and out.collect() == []


@pytest.mark.parametrize("toxic", [1, 2])
def test_toxicity_with_few_labels(spark, toxic):
    rows = [(i, f"you are a wretched filthbag number{i}" if i < 4 else f"a quiet garden with flowers and number{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 if i < 4 else 0) for i in [*range(toxic), *range(4, 20)]], "doc_id bigint, toxic int")
    scores = {r.doc_id: r.score for r in toxicity_scores(docs, labels, F.lit(True)).collect()}
    assert min(scores[i] for i in range(4)) > max(scores[i] for i in range(20, 40))
