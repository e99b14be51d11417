import collections

import pytest
from pyspark.sql import functions as F

from terrace.llm import mixing


def targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Water filling round by round, as the contract words it."""
    names = sorted(sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, spare, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while spare > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        want = {s: out[s] + spare * w[s] / total for s in open_}
        spare = 0.0
        for s, x in want.items():
            out[s] = min(x, cap * sizes[s])
            spare += x - out[s]
            if x >= cap * sizes[s]:
                open_.discard(s)
    return out


@pytest.fixture
def mixed(make_docs):
    rows = [(i, "w " * (1 + i % 7), "en", None if i % 11 == 0 else f"s{min(i % 5, 2)}") for i in range(600)]
    return {r["doc_id"]: r for r in mixing.mix(make_docs(rows)).collect()}, rows


def test_targets_and_taken_words(mixed):
    got, rows = mixed
    size = collections.Counter()
    for _, text, _, source in rows:
        size["0" + source if source else "1"] += len(text.split())
    want = targets(size)
    taken = collections.Counter()
    for r in got.values():
        src = "0" + r["source"] if r["source"] else "1"
        assert r["size"] >= 1 and 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == size[src]
        assert r["target"] == pytest.approx(want[src])
        taken[src] += r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 1


def test_shards_hold_equal_quotas_and_disjoint_blocks(mixed):
    got, _ = mixed
    # a pass of a document has exactly one shard, and a block is never split
    shard_of = {}
    for r in got.values():
        passes = [int(x) for x in r["shards"].split(",") if x]
        assert len(passes) == -(-r["taken"] // r["size"])
        for p, s in enumerate(passes):
            key = (r["source"], p, r["shuffle_key"][:2])
            assert shard_of.setdefault(key, s) == s and 0 <= s < 64


def test_tree_counts_are_exact(spark):
    tokens = spark.createDataFrame([("a", b, p) for b in range(100) for p in (1, 2)] + [("b", b, 1) for b in range(57)],
                                   "src string, block string, pass int")
    quotas = mixing.split_tree(tokens, 4, 2)
    by_shard = {r["shard"]: r["n"] for r in quotas.groupBy("shard").agg(F.sum("quota").alias("n")).collect()}
    assert sum(by_shard.values()) == 257 and max(by_shard.values()) - min(by_shard.values()) <= 1
    drawn = mixing.draw_blocks(tokens, quotas)
    assert drawn.count() == 257 and drawn.select("src", "block", "pass").distinct().count() == 257


def test_reruns_agree_whatever_the_partitions(make_docs):
    rows = [(i, "w " * (i % 9), "en", f"s{i % 3}") for i in range(200)]
    a, b = (sorted(map(tuple, mixing.mix(make_docs(rows, n)).collect())) for n in (1, 7))
    assert a == b


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == 8 and all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mix(no_docs).count() == 0


def test_clashing_extra_columns(make_docs):
    d = make_docs([(1, "a b"), (2, "c")]).withColumn("size", F.lit("x")).withColumn("taken", F.lit(-1)).withColumn("src", F.lit(0))
    assert {r["doc_id"]: r["size"] for r in mixing.mix(d).collect()} == {1: 2, 2: 1}


def test_one_source_with_nearly_all_words(make_docs):
    rows = [(i, "w " * 50, "en", "big") for i in range(50)] + [(100 + i, "w", "en", f"s{i}") for i in range(4)]
    got = mixing.mix(make_docs(rows)).collect()
    total = sum(r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - 1.5 * total) <= 5


def test_texts_are_attached_row_by_row(make_docs, odd_docs, no_docs):
    rows = [(i, f"w{i} " * (1 + i % 7), "en", f"s{i % 3}") for i in range(300)]
    rows += [(7, "again and again", "en", "s1")] * 40 + [(None, "no id " * (i % 3), None, "s2") for i in range(9)]
    rows += [(8, "one text", "en", None), (8, "another text", "en", None)]
    # a source of equal rows only: the rest ends among them
    rows += [(9, "a b c d e", "de", "t")] * 50
    shown = ["doc_id", "source", "size", "source_size", "target", "taken", "shards", "shuffle_key"]
    for docs in (make_docs(rows), make_docs(rows, 11), odd_docs, no_docs):
        got = mixing.mix_texts(docs)
        assert got.columns == shown + ["lang", "text", "n_chars"]
        cells = lambda df, *c: collections.Counter(map(tuple, df.select(*c).collect()))
        assert cells(got, "doc_id", "source", "lang", "text", "n_chars") == cells(docs, "doc_id", "source", "lang", "text", "n_chars")
        assert cells(got, *shown) == cells(mixing.mix(docs), *shown)
    assert len({r["taken"] for r in mixing.mix_texts(make_docs(rows)).where("doc_id = 9").collect()}) > 1


def test_texts_are_not_sorted(make_docs):
    plan = mixing.mix_texts(make_docs([(1, "a b"), (2, "c")]))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan and "Window" not in plan


def by_hand(rows, docs_out):
    """What is taken of each document, walked one after the other in the order of the permutation."""
    per = {(r["source"], r["doc_id"], r["size"]): r for r in docs_out}
    want = collections.Counter()
    for source in {r[3] for r in rows}:
        some = next(r for r in docs_out if r["source"] == source)
        words = round(some["target"])
        passes, rest = divmod(words, some["source_size"])
        mine = sorted((per[(source, i, len((t or "").split()))]["shuffle_key"], i, len((t or "").split())) for i, t, _, s in rows if s == source)
        at = 0
        for _, i, size in mine:
            want[(source, i, size, passes * size + max(0, min(size, rest - at)))] += 1
            at += size
    return want


def test_a_hot_id_is_drawn_as_if_row_by_row(make_docs):
    rows = [(i, "w " * (1 + i % 6), "en", f"s{i % 2}") for i in range(400)]
    rows += [(5, "a b c", "en", "s1")] * 700 + [(5, "a b c d", "en", "s1")] * 100 + [(6, "", "en", "s0")] * 50
    docs = make_docs(rows)
    got = mixing.mix(docs).collect()
    assert collections.Counter((r["source"], r["doc_id"], r["size"], r["taken"]) for r in got) == by_hand(rows, got)
    counted = mixing.mix_counted(docs)
    assert counted.count() <= 403 + 4 and counted.agg(F.sum("n")).first()[0] == len(rows)


def test_a_third_without_id(make_docs):
    rows = [(i, "w " * (1 + i % 6), "en", "s") for i in range(300)] + [(None, "one two", "en", "s")] * 6000
    got = mixing.mix(make_docs(rows))
    assert got.count() == 6300 and got.where("doc_id is null").count() == 6000
    assert mixing.mix_counted(make_docs(rows)).where("doc_id is null").count() <= 3
