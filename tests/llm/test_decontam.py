import hashlib
import random
import re

from pyspark.sql import functions as F

from terrace.llm import decontam

GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in GAP.split(low) if w]


def brute(docs, items, width=10):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if w and item is not None else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if own := grams.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def run(docs, bench, **kw):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.find_hits(docs, bench, **kw).collect()), key=str)


def test_random_texts_match_brute_force(spark, make_docs):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "b", "C", "é-x", "9"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 25]))) for i in range(6)] + [(90, text(12)), (90, text(12)), (7, None), (8, "!?")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(100 + i, text(4) + ". " + items[i][1] + " z " + text(3)) for i in range(6)]
    for rows in (items, items[5:]):
        got = run(make_docs(docs), benchmark(spark, rows))
        assert got == brute(docs, rows)
    # a broadcast that is cut into parts gives the same
    assert run(make_docs(docs), benchmark(spark, items), max_rows=20) == brute(docs, items)


def test_only_long_items(spark, make_docs):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(20))) for i in range(5)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(30)) + " " + " ".join(items[i % 5][1].split()[i % 11:i % 11 + 9 + i % 3]))
            for i in range(30)]
    assert run(make_docs(docs), benchmark(spark, items)) == brute(docs, items)


def test_odd_rows(spark, odd_docs, no_docs):
    bench = benchmark(spark, [(1, "plain words here"), (2, None), (None, "no id at all")])
    got = run(odd_docs, bench)
    assert len(got) == 8 and sum(r[2] for r in got) == 6 and got.count((4, 3, 3, ("1",))) == 2
    assert decontam.find_hits(no_docs, bench).count() == 0
    assert all(r[2] == 0 for r in run(odd_docs, benchmark(spark, [])))


def test_decontaminate_drops_only_hits(spark, make_docs):
    item = "one two three four five six seven eight nine ten eleven"
    docs = make_docs([(1, "x " + item), (2, "one two three"), (3, None), (None, item), (1, "other text")]).withColumn("mark", F.lit("m"))
    kept = decontam.decontaminate(docs, benchmark(spark, [(1, item)]))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("text is not null").collect()) == [(1, "other text"), (2, "one two three")]
    assert kept.count() == 3


def test_plan_is_native(spark, make_docs):
    plan = decontam.find_hits(make_docs([(1, "a")]), benchmark(spark, [(1, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_a_hot_row_is_looked_up_once_and_repeated(spark, make_docs):
    item = "one two three four five six seven eight nine ten"
    docs = make_docs([(1, "x " + item)] * 9000 + [(2, "clean")] * 3 + [(None, "clean")] * 2)
    hits = decontam.find_hits(docs, benchmark(spark, [(1, item)]))
    assert sorted(map(tuple, hits.groupBy("doc_id", "n_words", "n_hit").count().collect()), key=str) == sorted(
        [(1, 11, 10, 9000), (2, 1, 0, 3), (None, 1, 0, 2)], key=str)
    assert decontam.hit_groups(docs, benchmark(spark, [(1, item)])).count() == 3
    assert decontam.decontaminate(docs, benchmark(spark, [(1, item)])).count() == 5
