"""Long repeats against brute force over every start."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from terrace.llm import suffix_dedup
from terrace.llm.column_layers import batches, repeated_starts, runs


def brute(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def check(spark, texts, length, most=suffix_dedup.MOST):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, key int, p string")
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.dedup(df.repartition(3), length, most).collect()}
    assert [got[i] for i in range(len(texts))] == brute([(t or "").encode() for t in texts], length)


@pytest.mark.parametrize("seed,length,most,stretch", [(1, 3, 1, 37), (2, 12, 2, 1000), (3, 20, 4096, 61)])
def test_against_brute_force(spark, monkeypatch, seed, length, most, stretch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rng = random.Random(seed)
    letters = "abcdefghij"[:rng.randint(2, 10)] + "é"
    phrases = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 3 * length))) for _ in range(6)]
    texts = [None, "", "a" * 60, "ab" * 40] + [
        "".join(rng.choice(phrases) if rng.random() < .4 else rng.choice(letters) for _ in range(rng.randint(0, 40)))
        for _ in range(50)]
    check(spark, texts + texts[5:8] * 2, length, most)


def test_hot_line_and_hot_copies(spark):
    """A third of the rows are one text, another third hold a common passage between different neighbours."""
    rng = random.Random(5)
    noise = ["".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(60)]
    passage = "".join(rng.choice("xyz") for _ in range(24))
    texts = ["the same text in very many rows"] * 30 + [a + passage + b for a, b in zip(noise[:30], noise[30:])]
    texts += [n[:12] for n in noise[:30]]
    check(spark, texts, 20, most=4)
    check(spark, texts, 28, most=4)


def test_production_length_long_and_repeated_rows(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    passage = " ".join(rng.choice(words) for _ in range(110))
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 300))) for _ in range(20)]
    texts += [t[:700] + passage[k:k + 450] + t[700:] for k, t in enumerate(texts[:6])]
    texts += ["x" * 399, "x" * 400, "long " * 3000, texts[0]]
    check(spark, texts, 400)


def test_odd_rows_and_empty(spark, odd_docs, no_docs):
    rows = suffix_dedup.dedup(odd_docs).collect()
    assert len(rows) == 8 and {r["doc_id"]: r["n_removed"] for r in rows}[6] == 300_000
    assert suffix_dedup.dedup(no_docs).count() == 0
    whole = "no id in either row " * 30  # 600 bytes
    two = spark.createDataFrame([(None, whole), (None, whole)], "doc_id long, text string")
    assert [tuple(r)[:4] for r in suffix_dedup.dedup(two).collect()] == [(None, 600, 600, 1)] * 2


def test_layers_against_pairs():
    rng = random.Random(1)
    for _ in range(60):
        length, m = rng.randint(2, 6), rng.randint(1, 12)
        group = np.sort(np.array([rng.randint(0, 3) for _ in range(m)]))
        lead = np.array([rng.randint(0, 4) for _ in range(m)])
        body = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 12))) for _ in range(m)]
        weight = np.array([rng.choice([1, 1, 1, 2]) for _ in range(m)])
        out = repeated_starts(body, lead, group, weight, length)
        for i in range(m):
            for j in range(len(body[i]) - length + 1):
                want = weight[i] > 1
                for k in range(m):
                    at = j - lead[i] + lead[k]
                    want |= k != i and group[k] == group[i] and at >= 0 and body[k][at:at + length] == body[i][j:j + length]
                assert bool(out[i, j]) == want


def test_batches_keep_groups_whole():
    rows = [(g, n) for g in range(7) for n in range(g)]
    got = list(batches(iter(rows), 4))
    assert [r for b in got for r in b] == rows
    assert all(not {r[0] for r in a} & {r[0] for r in b} for a, b in zip(got, got[1:]))
    assert runs(np.array([True, True, False, True])) == [(0, 1), (3, 3)]
