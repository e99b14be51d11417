import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import langid_crf
from terrace.llm.common import held_out


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    k, lengths = 3, np.array([4, 1, 5])
    starts = np.array([0, 4, 5])
    e, move = rng.normal(size=(10, k)), rng.normal(size=(k, k))
    gamma, moved = langid_crf.forward_backward(e, starts, lengths, move)
    want_moved = np.zeros((k, k))
    for s, n in zip(starts, lengths):
        paths = list(itertools.product(range(k), repeat=int(n)))
        w = np.array([np.exp(sum(e[s + t, y] for t, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        w /= w.sum()
        for t in range(n):
            for y in range(k):
                assert gamma[s + t, y] == pytest.approx(sum(x for x, p in zip(w, paths) if p[t] == y))
        for x, p in zip(w, paths):
            for a, b in zip(p, p[1:]):
                want_moved[a, b] += x
    assert moved == pytest.approx(want_moved)


STEMS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "be"], "cc": ["xo", "qui", "ez", "ñar"]}


def words(lang, n, rng):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture
def model(make_docs):
    rng = random.Random(1)
    rows = [(i, words(x, 60, rng), x, "s") for i in range(240) for x in [("aa", "bb", "cc")[i % 3]]]
    docs = make_docs(rows)
    return docs, langid_crf.train(docs)


def test_held_out_accuracy(model):
    docs, m = model
    p = langid_crf.identify(docs, m).join(docs, "doc_id").where(held_out(F.col("doc_id")))
    assert p.count() > 30 and p.where(F.col("lang_pred") != F.col("lang")).count() == 0
    assert p.where("score < 0.8 or score > 1").count() == 0


def test_code_switched_text(model, make_docs):
    _, m = model
    rng = random.Random(2)
    text = words("aa", 20, rng) + " " + words("bb", 25, rng) + " " + words("cc", 30, rng)
    got = sorted(langid_crf.label_words(make_docs([(1, text), (2, None)]), m).collect(), key=lambda r: r["first_word"])
    main = [(r["lang"], r["last_word"] - r["first_word"]) for r in got if r["last_word"] - r["first_word"] > 5]
    assert [x for x, _ in main] == ["aa", "bb", "cc"] and got[0]["first_word"] == 0 and got[-1]["last_word"] == 74
    assert all(b["first_word"] == a["last_word"] + 1 for a, b in zip(got, got[1:]))
    assert m.move.diagonal().min() > m.move[~np.eye(3, dtype=bool)].max()   # staying is likelier than switching


def test_long_texts_and_caches(model, make_docs, monkeypatch):
    docs, m = model
    rng = random.Random(4)
    text = words("bb", 3000, rng)
    whole = m.marginals([_w for _w in [langid_crf._WORD.findall(text)]])[0]
    monkeypatch.setattr(langid_crf, "CACHE", 10)
    assert np.array_equal(whole, m.marginals([langid_crf._WORD.findall(text)])[0]) and len(whole) == 3000
    assert np.allclose(whole.sum(axis=1), 1)


def test_odd_rows(model, odd_docs, no_docs):
    _, m = model
    got = langid_crf.identify(odd_docs, m).collect()
    assert len(got) == 8 and sum(r["lang_pred"] == "und" and r["score"] == 0 for r in got) == 3
    assert langid_crf.identify(no_docs, m).count() == 0
    empty = langid_crf.train(no_docs)
    assert {r["lang_pred"] for r in langid_crf.identify(odd_docs.withColumn("p", F.lit(1)), empty).collect()} == {"und"}


def test_ids_of_any_type(spark):
    rows = [(f"d{i}", "der hund und die katze" if i % 2 else "the dog and the cat", "de" if i % 2 else "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    from terrace.llm import langid_crf
    got = {r["doc_id"]: r["lang_pred"] for r in langid_crf.identify(docs, langid_crf.train(docs)).collect()}
    assert got == {i: lang for i, _, lang in rows}
