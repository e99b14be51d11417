import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import jaccard_join as J


def shingle_set(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n=4, num=85, den=100):
    sets = {i: shingle_set(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                inter = len(sets[a] & sets[b])
                if den * inter >= num * (len(sets[a]) + len(sets[b]) - inter):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(rng, size, n, edits):
    """A text, and copies of it or of one another with a few words changed."""
    words = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    out = [words]
    while len(out) < size:
        copy = list(rng.choice(out))
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10 ** 6)}"
        out.append(copy)
    return [" ".join(w) for w in out]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    out = []
    for size, n, edits in [(12, 60, 2), (10, 120, 4), (8, 25, 1), (6, 300, 10), (5, 8, 1), (15, 90, 3)]:
        out += family(rng, size, n, edits)
    passage = " ".join(f"p{i}" for i in range(60))     # shared by documents that do not link
    out += [" ".join(f"u{rng.randint(0, 10 ** 6)}" for _ in range(rng.randint(30, 90))) + " " + passage for _ in range(15)]
    out += [passage, passage.upper(), "one two", "one two", "One Two three", "a b c d", "a  b\tc\nd", "", None]
    rng.shuffle(out)
    return list(enumerate(out, start=3))


def components(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_matches_brute_force(make_docs, texts):
    want = brute(texts)
    assert components(J.link_documents(make_docs(texts))) == want
    assert len({c for _, c in want.values()}) < len(want) - 25


def test_other_shingles_and_threshold(make_docs, texts):
    assert components(J.link_documents(make_docs(texts), words=5, num=80)) == brute(texts, 5, 80)


@pytest.mark.parametrize("limit", [2, 5])
def test_regions_join_recursively(make_docs, texts, limit):
    """Tiny task limits: groups go through Voronoi cuts and blocks, with the same result."""
    assert components(J.link_documents(make_docs(texts), limit_sets=limit)) == brute(texts)


def test_signatures_meet_for_every_linked_pair():
    rng = random.Random(1)
    for _ in range(4000):
        n = rng.choice([1, 2, 3, 5, 7, 8, 13, 16, 40, 130])
        a = {rng.getrandbits(64) for _ in range(n)}
        b = set(rng.sample(sorted(a), max(1, n - rng.randint(0, max(1, n // 6))))) | {rng.getrandbits(64) for _ in range(rng.randint(0, max(1, n // 10)))}
        inter = len(a & b)
        if 100 * inter >= 85 * (len(a) + len(b) - inter):
            x, y = (J.signatures(np.array(sorted(s), dtype=np.uint64)) for s in (a, b))
            assert set(x) & set(y), (len(a), len(b), inter)


def test_region_join_matches_all_pairs():
    rng = random.Random(4)
    for trial in range(30):
        base = [rng.getrandbits(63) for _ in range(60)]
        sets = []
        for _ in range(40):
            own = list(rng.choice([base, [int(x) for x in rng.choice(sets)]] if sets else [base]))
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.getrandbits(63)
            sets.append(np.unique(np.array(own, dtype=np.uint64)))
        home = np.array([trial % 2 == 0 or rng.random() < 0.6 for _ in sets])
        root = list(range(40))
        for i in range(40):
            for j in range(i):
                inter = len(np.intersect1d(sets[i], sets[j]))
                if (home[i] or home[j]) and 100 * inter >= 85 * (len(sets[i]) + len(sets[j]) - inter) and root[i] != root[j]:
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
        assert list(J.link_region(sets, home)) == root


def test_components_of_a_long_path(spark):
    rng = random.Random(3)
    ids = rng.sample(range(1000), 60)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(5000, 5001), (5001, 5000), (7, 7)], "a long, b long")
    got = {r["v"]: r["root"] for r in J.components(edges).collect()}
    assert got == dict.fromkeys(ids, min(ids)) | {5000: 5000, 5001: 5000}


def test_keep_one(make_docs, texts):
    docs = make_docs(texts + [(3, "an extra text of a repeated id"), (None, None)]).withColumn("mark", F.lit("m"))
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    got = {(r["doc_id"], r["text"]) for r in kept.collect()}
    want = {i for i, (n, c) in brute(texts, 5, 80).items() if c == i}
    assert {i for i, _ in got if i is not None} == want | {3} and (3, "an extra text of a repeated id") in got


BRIDGE = ["a b c d e f g h i j k l m n o p q r s t u v w x y z a1 b1 c1 d1 e1 f1 g1 h1 i1 j1 k1 l1 m1 n1 o1 p1",
          "a b c d e f g h i j k l m n o p q r s t u v w x y z a1 b1 c1 d1 e1 f1 g1 h1 i1 j1 k1 l1 m1 n1 o1",
          "d e f g h i j k l m n o p q r s t u v w x y z a1 b1 c1 d1 e1 f1 g1 h1 i1 j1 k1 l1 m1 n1 o1"]


@pytest.mark.parametrize("limit", [2, J.LIMIT_SETS])
def test_links_through_a_row_without_id(make_docs, limit):
    """Texts 1 - B - 3: the ends do not link with each other; B has no id."""
    ends = [(1, BRIDGE[0] + " q1 r1 s1"), (3, BRIDGE[2])]
    assert brute([ends[0], (2, BRIDGE[1]), ends[1]])[3][1] == 1 and brute(ends)[3][1] == 3
    got = J.link_documents(make_docs([ends[0], (None, BRIDGE[1]), ends[1]]), limit_sets=limit).collect()
    assert {r["component_id"] for r in got} == {1} and len(got) == 3


def test_random_null_and_repeated_ids(make_docs, texts):
    """Ids do not decide what links: rows are compared by the components of their texts."""
    rng = random.Random(8)
    rows = [(rng.choice([None, None, 5, 6, i]), t) for i, t in texts]
    want = brute(texts)
    groups = {}
    for (i, t), (own, _) in zip(rows, texts):
        groups.setdefault(want[own][1], []).append(i)
    want_rows = sorted(((i, want[own][0], min((x for x in groups[want[own][1]] if x is not None), default=None) if want[own][0] else i)
                        for (i, t), (own, _) in zip(rows, texts)), key=str)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.link_documents(make_docs(rows)).collect()), key=str)
    assert got == want_rows


def test_keep_one_of_equal_rows(make_docs):
    same = "one two three four five six seven eight nine ten"
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(1, same)] * 5 + [(2, same)] + [(None, near)] * 3 + [(None, near + " more")] + [(7, None), (7, None), (8, "alone here")]
    kept = [(r["doc_id"], r["text"]) for r in J.keep_one(make_docs(rows)).collect()]
    assert kept.count((1, same)) == 1 and (2, same) not in kept
    assert sum(i is None and t in (near, near + " more") for i, t in kept) == 1
    assert kept.count((7, None)) == 2 and kept.count((8, "alone here")) == 1 and len(kept) == 5


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.link_documents(odd_docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (None, 4, None), (5, 1, 5), (6, 1, 6)], key=str)
    assert J.link_documents(no_docs).count() == 0 and J.keep_one(no_docs).count() == 0
    clash = odd_docs.withColumn("key", F.lit(1)).withColumn("n", F.lit(1)).withColumn("bucket", F.lit("b"))
    assert J.link_documents(clash).count() == 8 and J.keep_one(clash).columns == clash.columns
