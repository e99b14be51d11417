import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrace.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def spans(df):
    return {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in df.collect()}


def test_base_spans_match_the_patterns(make_docs):
    rng = random.Random(6)
    bits = ["password", "PassWd", "api_key", "apikey", "token", "secret", "=", ": ", " ", "'", '"', "abc", "12345678", "AKIA",
            "AKIAABCDEFGHIJKL", "0123456789abcdef" * 2, "🙂", "é", ".", "-", "\n"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(800)]
    rows += [(1000, "password=abcdefgh"), (1001, "token=passwd:abcdefgh123"), (1002, "x" * 40_000 + " secret = 'abcdefghi'")]
    found = secrets.find(make_docs(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert [tuple(s) for s in r["base"]] == base(dict(rows)[r["doc_id"]]), r["doc_id"]
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))


def strings(kind, n, rng):
    if kind == "random":
        return ["".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(40)) for _ in range(n)]
    stems = ["Request", "handler", "Factory2", "config", "Item3", "value", "Index"]
    return ["".join(rng.choice(stems) for _ in range(8))[:40] for _ in range(n)]


def test_random_strings_are_added_and_identifiers_left(make_docs):
    rng = random.Random(8)
    random_, names = strings("random", 150, rng), strings("names", 150, rng)
    rows = [(i, f"see {s} there") for i, s in enumerate(random_ + names)]
    got = spans(secrets.find(make_docs(rows)))
    hit = [bool(got[i]) for i, s in enumerate(random_ + names)]
    # hex or lacking a class of symbols by chance: not base62, or none at all
    assert sum(hit[:150]) >= 135 and sum(hit[150:]) <= 15
    assert all(s[1] == 3 and (s[0], s[2]) == (4, 44) for v in list(got.values())[:150] for s in v)


def test_battery_rejects_regular_strings(spark):
    rng = random.Random(9)
    rows = [(0, "aB3" * 12), (1, "A1b2C3d4E5f6G7h8I9j0K1l2M3"), (2, "".join(rng.choice(secrets.ALPHABETS["base62"]) for _ in range(60)) + "aA0")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", secrets.battery(secrets.located(F.col("text"), secrets.RUN)).alias("t"))
    p = {r["doc_id"]: [x["p"] for x in r["t"]] for r in df.collect()}
    assert p[0][0] < 1e-6 and p[2][0] > 0.001 and len(p[1]) == 1


def test_frame(odd_docs, no_docs, make_docs):
    got = secrets.find(odd_docs).collect()
    assert len(got) == 8 and not any(r["spans"] for r in got)
    assert secrets.find(no_docs).count() == 0
    d = make_docs([(1, "token=abcdefgh1")]).withColumn("base", F.lit(1)).withColumn("hex", F.lit("x")).withColumn("tested", F.lit(0))
    assert spans(secrets.find(d)) == {1: [(0, 0, 15)]}


def test_plan_is_native(make_docs):
    text = secrets.located(F.col("text"), secrets.RUN)
    plan = make_docs([(1, "a")]).select(secrets.battery(text))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def of(symbols, n, size, rng):
    return ["".join(rng.choice(symbols) for _ in range(size)) for _ in range(n)]


def test_one_case_tokens_alone_and_behind_separators(make_docs):
    rng = random.Random(10)
    low, up = "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    texts = ([f"see {s} there" for s in of(up, 150, 24, rng)] + [f"see key-{s} there" for s in of(low, 150, 32, rng)]
             + [f"get /v1/files/{s}/raw now" for s in of(low, 150, 40, rng)])
    words = ["how", "to", "bake", "bread", "at", "home", "with", "little", "time", "report", "season", "market", "release", "notes"]
    slugs = ["see " + "-".join([str(rng.randint(1990, 2030))] + [rng.choice(words) for _ in range(7)]) + " there" for _ in range(150)]
    names = ["see " + "_".join(rng.choice(words).upper() for _ in range(6)) + f"_{rng.randint(1, 9)} there" for _ in range(150)]
    rows = list(enumerate(texts + slugs + names))
    got = spans(secrets.find(make_docs(rows)))
    hit = [any(k == 3 for _, k, _ in got[i]) for i, _ in rows]
    assert sum(hit[:150]) >= 130 and sum(hit[150:300]) >= 130 and sum(hit[300:450]) >= 130
    assert sum(hit[450:600]) <= 15 and sum(hit[600:]) <= 15
    for s in got.values():  # a run and its part are not both reported
        assert all(a[2] <= b[0] for a, b in zip(s, s[1:]))


def test_every_mixed_run_is_tested(spark):
    rng = random.Random(11)
    classes = ["0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"]
    runs = ["X7K9Q0ZP1M8R4T6WB2YD3H5J", "key-3ax6xnjp29jd6fds4gc373sgvjxteol0"]
    for _ in range(400):
        used = rng.sample(classes, rng.randint(1, 3))
        runs.append("".join(rng.choice("".join(used) + rng.choice(["", "-_+/"])) for _ in range(rng.randint(20, 70))))
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string").select(
        "doc_id", secrets.battery(secrets.located(F.col("text"), secrets.RUN)).alias("t"))
    for r in df.collect():
        s = runs[r["doc_id"]]
        mixed = sum(bool(set(s) & set(c)) for c in classes) > 1
        assert [(t["start"], t["end"]) for t in r["t"]] == ([(0, len(s))] if mixed else []), s
        assert all(0 <= t["p"] <= 1 for t in r["t"])
    parts = spark.createDataFrame([("a-" + "b1" * 12 + "/" + "C2" * 10 + " " + "d3" * 15,)], "text string").select(
        secrets.located(F.col("text"), secrets.PART).alias("p")).first()["p"]
    assert [(p["start"], p["end"], p["hit"]) for p in parts] == [(2, 26, "b1" * 12), (27, 47, "C2" * 10)]


def test_running_totals_and_outermost_spans(spark):
    rng = random.Random(13)
    rows = [(i, [rng.randint(0, 9) for _ in range(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, v array<int>")
    for r in df.select("v", secrets.running(F.col("v"), lambda a, b: a + b, 0).alias("sum"), secrets.running(F.col("v"), F.greatest, 0).alias("top")).collect():
        assert r["sum"] == list(np.cumsum(r["v"])) and r["top"] == [max(r["v"][:i + 1]) for i in range(len(r["v"]))]
    spans = []
    for i in range(300):
        starts = [(rng.randint(0, 60), rng.choice([0, 1, 2, 3, 3, 3]), rng.randint(1, 12)) for _ in range(rng.randint(0, 12))]
        spans.append((i, sorted({(a, k, a + n) for a, k, n in starts})))
    df = spark.createDataFrame(spans, "doc_id long, s array<struct<start:int,kind:int,end:int>>")
    got = {r["doc_id"]: [tuple(x) for x in r["o"]] for r in df.select("doc_id", secrets.outermost(secrets.clear_of_base(F.col("s"))).alias("o")).collect()}
    for i, s in spans:
        clear = [x for x in s if x[1] == 3 and not any(b[1] < 3 and b[0] < x[2] and x[0] < b[2] for b in s)]
        assert got[i] == [x for x in clear if not any(y != x and y[0] <= x[0] and x[2] <= y[2] for y in clear)], s


def test_many_matches_in_one_text(make_docs):
    def text(n):
        return " ".join(f"token=abcdefgh{i:06d} {i:06d}-Qx7{i:08x}Zk{i * 7919:010d}" for i in range(n))

    took = []
    for n in (50, 16_000):
        d = make_docs([(1, text(n))]).select("doc_id", secrets.located(F.col("text"), secrets.ASSIGN, group=2).alias("a"))
        t = time.time()
        (row,) = d.collect()
        took.append(time.time() - t)
        assert [(s["start"], s["end"]) for s in row["a"]] == [(m.start(), m.end()) for m in ASSIGN.finditer(text(n))]
    assert took[1] < 5 + took[0]
    (row,) = secrets.find(make_docs([(1, text(4000))])).collect()
    assert [tuple(s) for s in row["base"]] == base(text(4000))


def battery_by_numpy(s, alphabet):
    k, n, v = len(alphabet), len(s), np.array([alphabet.index(c) for c in s])
    counts = np.bincount(v, minlength=k)
    chi = ((counts - n / k) ** 2 / (n / k)).sum()
    mid = (k - 1) / 2
    high = v > mid
    z = [max(0.0, (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)),
         ((high[1:] != high[:-1]).sum() - (n - 1) / 2) / math.sqrt((n - 1) / 4),
         ((v[1:] - mid) * (v[:-1] - mid)).sum() / (np.mean((np.arange(k) - mid) ** 2) * math.sqrt(n - 1))]
    return min(1.0, 3 * min(math.erfc(abs(x) / math.sqrt(2)) for x in z))


def test_statistics_and_cut_offs_against_numpy(spark):
    rng = random.Random(14)
    rows = [(i, "aZ9" + "".join(rng.choice(secrets.ALPHABETS["base62"][:rng.choice([8, 30, 62])]) for _ in range(rng.randint(17, 90)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", secrets.battery(secrets.located(F.col("text"), secrets.RUN)).alias("tested"))
    groups = {}
    for r in df.collect():
        (t,) = r["tested"]
        s = dict(rows)[r["doc_id"]]
        assert t["enc"] == "base62" and t["p"] == pytest.approx(battery_by_numpy(s, secrets.ALPHABETS["base62"]), abs=2e-6)
        groups.setdefault(f"base62:{max(c for c in secrets.LENGTH_CLASSES if c <= len(s))}", []).append(t["p"])
    want = {}
    for stratum, ps in groups.items():
        ps = np.array(ps)
        random_ = min(len(ps), 2 * (ps > 0.5).sum())
        ok = [t for t in secrets.CUT_OFFS if (ps > t).any() and 1 - random_ * (1 - t) / (ps > t).sum() <= 0.1]
        if ok:
            want[stratum] = min(ok)
    assert secrets.cut_offs(df, 0.1) == want and want
