"""Filter orders against a document-by-document walk."""

import re
from itertools import permutations

from tests.llm.conftest import ODD_ROWS

from terrace.llm import filter_audit


def brute(rows, labels):
    docs = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in docs:
        if i is not None and (t not in first or i < first[t]):
            first[t] = i
    out = {}
    for part in {s for _, _, s in docs}:
        fails = []
        for i, t, s in docs:
            if s != part:
                continue
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
            good = any(d == i and q == 1 for d, q, _ in labels if d is not None)
            toxic = any(d == i and x == 1 for d, _, x in labels if d is not None)
            fails.append(({k for k, v in f.items() if v}, good, toxic))
        share = dict.fromkeys("ABCDE", 0)
        got = {}
        for o in permutations("ABCDE"):
            left = fails
            for n, x in enumerate(o):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                all_failing = sum(x in d[0] for d in fails)
                got["".join(o), n + 1] = [len(left), len(gone), all_failing - len(gone), sum(d[0] == {x} for d in fails),
                                          sum(d[1] for d in gone), sum(d[2] for d in gone)]
                share[x] += len(gone)
        for (o, n), v in got.items():
            out[part, o, n] = (*v, share[o[n - 1]])
    return out


def run(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, 1, "y") for i, t, s in rows], "doc_id long, text string, source string, mask int, part string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(docs.repartition(3), lab).collect()}


def test_against_a_walk(spark):
    many = " ".join(f"w{i}" for i in range(60))
    rows = [(1, many, "a"), (2, many, "a"), (3, many, "b"), (3, many, "b"), (4, many + " #", "a"), (5, "w " * 80, "a"),
            (6, "SHOUT " * 60, "b"), (7, many.upper(), "b"), (8, None, None), (9, "", ""), (10, " \t ", "a"),
            (None, many, "a"), (None, "x", "b"), (11, "é " * 51 + many, "a"), (12, "\n" + many + " ", "b")]
    rows += [(100 + i, "copied " + many, "a") for i in range(15)] + [(50, "one row", "a")] * 8
    rows += [(r[0], r[1], r[3]) for r in ODD_ROWS]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, None, 1), (104, 1, 1), (None, 1, 1), (999, 1, 1), (8, 0, 1), (50, 1, 0)]
    want = brute(rows, labels)
    assert run(spark, rows, labels) == want and len(want) == 600 * len({s or "" for _, _, s in rows})


def test_empty(spark):
    assert run(spark, [], []) == {}


def test_texts_stay_where_they_are(spark, make_docs):
    lab = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    plan = filter_audit.audit(make_docs([(1, "a b c")]), lab)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
