"""The two trained models: held-out figures, defined results of odd rows, traversal beside plain loops."""

import os
import random

import numpy as np
import pytest

from cadastra.llm import language, quality

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")

VOICES = {
    "aa": ["ba", "ko", "lim", "ter", "sa"], "bb": ["xu", "zha", "qing", "wo", "yi"], "cc": ["øre", "ås", "kjæ", "bø", "gul"],
}


def prose(lang, words, rng):
    return " ".join("".join(rng.choice(VOICES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(1)
    rows = [(i, prose(lang := rng.choice(list(VOICES)), rng.randrange(3, 80), rng), lang, "s", 7) for i in range(500)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


def test_language_of_unseen_documents(spark, spoken):
    model = language.fit_languages(spoken)
    got = language.predict_languages(spoken, model).join(spoken.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 500 and 80 < len(held) < 170
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.rejected for r in got]) < 0.01
    kept = language.accepted(spoken, model)
    assert kept.columns == spoken.columns and kept.count() >= 495


def test_prediction_sees_only_the_text(spark, spoken):
    model = language.fit_languages(spoken)
    first = {r.doc_id: (r.lang_pred, r.score) for r in language.predict_languages(spoken, model).collect()}
    blind = spoken.selectExpr("doc_id + 10000 AS doc_id", "text", "CAST(NULL AS STRING) AS lang", "'t' AS source")
    second = {r.doc_id - 10000: (r.lang_pred, r.score) for r in language.predict_languages(blind, model).collect()}
    assert first == second


def test_learning_leaves_fold_two_and_null_labels_out(spark, spoken):
    from pyspark.sql import functions as F

    fold = language.remainder() == 2
    changed = spoken.withColumn("lang", F.when(fold, F.lit("zz")).otherwise(F.col("lang")))
    a, b = language.fit_languages(spoken), language.fit_languages(changed)
    assert a.languages == b.languages == sorted(VOICES) and np.array_equal(a.table, b.table)


def test_odd_texts_and_tables(spark, spoken):
    model = language.fit_languages(spoken)
    rows = [(1, None), (2, ""), (3, "123 ... \n"), (4, "ba"), (None, "xu zha"), (5, "ba " * 400_000), (5, "ba")]
    got = {(r.doc_id, r.lang_pred): r for r in language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (None, "bb"), (5, "aa")} == set(got)
    assert all(got[i, "und"].score == 0 and got[i, "und"].rejected for i in (1, 2, 3))
    assert got[None, "bb"].held_out is False
    empty = spoken.where("false")
    nothing = language.fit_languages(empty)
    assert language.predict_languages(empty, nothing).collect() == []
    assert {r.lang_pred for r in language.predict_languages(spoken, nothing).collect()} == {"und"}


def test_subwords_do_not_depend_on_slices(monkeypatch):
    texts = ["Ein Satz, kurz.", None, "", "é" * 50, "a b c"]

    def counts():
        out = np.zeros((len(texts), 64), int)
        for number, bucket in language.subwords(texts, 64):
            np.add.at(out, (number, bucket), 1)
        return out

    whole = counts()
    monkeypatch.setattr(language, "SLICE", 5)
    assert np.array_equal(whole, counts())
    assert whole[1].sum() == whole[2].sum() == 0


@needs_tables
def test_held_out_languages_of_the_shared_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = language.predict_languages(docs, language.fit_languages(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    rows = [r for r in got.collect() if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.99


def area(score, label):
    order = np.argsort(score)
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    good = label.sum()
    return (rank[label == 1].sum() - good * (good + 1) / 2) / (good * (len(label) - good))


@needs_tables
def test_held_out_quality_of_the_shared_table(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_quality(docs, quality.fit_quality(docs, labels))
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert area(np.array([r.score for r in rows]), np.array([r.quality for r in rows])) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_flat_trees_equal_plain_traversal():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(600, 5)).round(1)
    labels = ((rows[:, 0] > 0.2) ^ (rows[:, 3] > 0)).astype(float)
    forest = quality.grow(rows, labels, trees=25, depth=3)
    scores = forest.score(rows)
    for row, score in zip(rows[:50], scores, strict=False):
        total = forest.start
        for statistic, threshold, value in zip(forest.statistic, forest.threshold, forest.value, strict=True):
            node = 0
            while node < len(statistic):
                node = 2 * node + (2 if row[statistic[node]] > threshold[node] else 1)
            total += value[node - len(statistic)]
        assert abs(1 / (1 + np.exp(-total)) - score) < 1e-9
    assert area(scores, labels) > 0.98


def test_quality_of_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(["", None, " ", "one", "a b\n" * 300, "x" * 200_000, "é | # 12"])] + [(3, "one"), (None, "z")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(0, 1), (1, None), (3, 1), (3, 0), (77, 0), (None, 1)], "doc_id long, quality int")
    got = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = quality.fit_quality(docs, labels.where("false"))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(docs.where("false"), none).collect() == []
    assert quality.statistics(["", None]).sum() == 0
