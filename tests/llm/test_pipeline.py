import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from terrace.llm import pii
from terrace.llm.common import small_batches
from tests.llm.test_decontam import brute as windows
from tests.llm.test_jaccard import brute as components


@pytest.fixture
def corpus(spark, make_docs, scratch):
    """A small corpus with planted cases; returns the folder and the rows."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("bdfgkl") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    plain = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    item = plain(14)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        text = plain(40)
        if toxic:
            text += ". You idiot. " + plain(3) + " scum"
        if i % 50 == 7:
            text = plain(5) + " " + item + " " + plain(5)
        if i % 50 == 9:
            text += f" mail me a{i}@b.org or call +1 (555) 123-4567"
        rows.append((i, text, "en", f"s{i % 3}"))
        if i % 2 and not toxic:
            labels.append((i, 1, 0))
        elif toxic and i % 2 == 0:
            labels.append((i, 0, 1))
    rows += [(1000 + i, rows[i + 1][1] + " extra", "en", "s0") for i in range(0, 40, 2)] + [(2000, None, "en", None), (2001, "", None, "s1")]
    make_docs(rows).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    return scratch, rows, item


def test_stages_against_brute_force(spark, corpus):
    folder, rows, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    columns, have = docs.columns, {r[0]: r[1] for r in rows}
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert len(got) == docs.count()
        if name == "toxicity":
            want = {i: t for i, t in have.items() if not t or "idiot" not in t}
        elif name == "near_duplicates":
            want = {i: have[i] for i, (n, c) in components(list(have.items()), 5, 80).items() if c == i}
            assert len(want) < len(have)
        elif name == "decontamination":
            want = {i: have[i] for i, _, hit, _ in windows(list(have.items()), [(1, item)]) if not hit}
            assert len(want) < len(have)
        elif name == "personal_data":
            want = {i: None if t is None else pii.redacted(t) for i, t in have.items()}
            assert want != have and all("@" not in (t or "") and "+1" not in (t or "") for t in want.values())
        else:
            want = have
        assert got == want, name
        assert k == len(P.STAGES) - 1 or docs.columns == columns
        have = got


def test_run_is_the_stages_in_a_row(spark, corpus):
    folder, rows, _ = corpus
    out = P.run(spark, folder).toPandas()
    assert 200 < len(out) < 330 and out.doc_id.is_unique
    total = out["size"].sum()
    assert abs(out.taken.sum() - 1.5 * total) <= 3 and (out.taken <= 2 * out["size"]).all()
    assert P.ORACLE_SQL is None


def test_mixture_holds_the_masked_texts(spark, corpus):
    folder, rows, _ = corpus
    texts = {r["doc_id"]: r["text"] for r in P.run(spark, folder).collect()}
    raw = {r[0]: r[1] for r in rows}
    masked = [i for i, t in texts.items() if t != raw[i]]
    assert masked and all(texts[i] == pii.redacted(raw[i]) for i in masked)


def test_few_bytes_reach_python_at_once(spark):
    """A worker holds several copies of a batch and keeps the memory of its largest."""
    row = 200_000
    docs = spark.range(64, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), row).alias("text"))
    sizes = small_batches(docs).mapInPandas(
        lambda frames: (pd.DataFrame({"n": [int(f["text"].str.len().sum())]}) for f in frames), "n long").collect()
    assert sum(r["n"] for r in sizes) == 64 * row
    assert max(r["n"] for r in sizes) <= (2 << 20) + row
