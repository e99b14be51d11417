import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import importance


@pytest.fixture
def labelled(spark, make_docs):
    rng = random.Random(5)
    good = ["ana", "beto", "cilu", "doma", "evi", "foru"]
    rows, labels = [], []
    for i in range(600):
        g = int(i % 3 > 0)
        words = [rng.choice(good) for _ in range(rng.randint(20, 60))]
        if not g:
            words = [w + rng.choice(["%%%", "$$$"]) if rng.random() < 0.7 else w for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, g, 0))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_counts_cover_all_documents(labelled):
    docs, _, rows = labelled
    want = np.zeros(importance.BUCKETS)
    for _, text in rows:
        want += np.bincount(importance.ngrams([text])[0], minlength=importance.BUCKETS)
    assert np.array_equal(importance.counts(docs), want)


def test_good_documents_weigh_more_and_are_drawn(labelled):
    docs, labels, rows = labelled
    m = importance.train(docs, labels)
    s = importance.resample(importance.score(docs, m), keep=0.5).join(labels, "doc_id").toPandas()
    assert s.selected.sum() == 300 and (s[s.quality == 0].selected.mean() < 0.1)
    assert ((s.score >= 0.5) == (s.quality == 1)).mean() > 0.98
    # the draw is the top of the noisy weights
    assert s[s.selected].noisy_weight.min() > s[~s.selected].noisy_weight.max()
    assert set(s[s.selected].doc_id) == set(s.sort_values("noisy_weight").tail(300).doc_id)


def test_gumbel_draw_follows_the_weights(spark):
    # one of two: with log-weights 0 and ln 3 the second is drawn three times in four
    got = 0
    for seed in range(8):
        rows = spark.createDataFrame([(i, 0.0 if i % 2 else float(np.log(3)), 0.5) for i in range(400)], "doc_id long, log_ratio double, score double")
        r = importance.resample(rows, keep=0.05, temperature=1.0, seed=seed).where("selected").toPandas()
        assert len(r) == 20
        got += (r.doc_id % 2 == 0).sum()
    assert 0.62 < got / 160 < 0.88


def test_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = importance.train(odd_docs, none)
    s = importance.score(odd_docs.withColumn("score", F.lit("x")), m).toPandas()
    assert len(s) == 8 and (s.log_ratio == importance.EMPTY).sum() == 3 and s[s.log_ratio == importance.EMPTY].score.max() == 0
    assert importance.resample(importance.score(odd_docs, m), 0.5).where("selected").count() == 4
    assert importance.resample(importance.score(odd_docs, m), 1.0).where("selected").count() == 8
    assert importance.resample(importance.score(no_docs, importance.train(no_docs, none))).count() == 0


def test_the_edge_is_refined_to_a_few_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.normal() / 50), 0.5) for i in range(3000)] + [(7000, 0.01, 0.5)] * 1500
    df = spark.createDataFrame(rows, "doc_id long, log_ratio double, score double")
    for keep in (0.05, 0.5, 0.9):
        for temperature in (1.0, 1e-6):
            a = importance.resample(df, keep=keep, temperature=temperature, edge_rows=2).toPandas()
            assert len(a) == 4500 and a.selected.sum() == int(4500 * keep)
            assert a[a.selected].noisy_weight.min() >= a[~a.selected].noisy_weight.max()
            b = importance.resample(df, keep=keep, temperature=temperature).toPandas()
            count = lambda x: sorted(x[x.selected].groupby("doc_id").size().items())
            assert count(a) == count(b)


def test_a_hot_row_at_the_edge_is_chosen_in_part(spark):
    rows = [(1, 0.5, 0.5)] * 9000
    r = importance.resample(spark.createDataFrame(rows, "doc_id long, log_ratio double, score double"), keep=0.5, edge_rows=10)
    assert r.groupBy("selected").count().orderBy("selected").collect() == [(False, 4500), (True, 4500)]
