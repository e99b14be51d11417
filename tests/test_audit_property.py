"""The Spark audit against a brute-force sequential implementation of the
reference's algorithm (records visited in order, a set of seen keys), on random
batches where one key holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import Rule, audit


def brute_force(rows):
    """rows: (seq, k, name, v) in record order -> per-seq issue lists and counters."""
    seen, out = set(), {}
    m = dict(missing=0, dup=0, rule=0, rejected=0)
    for seq, k, name, v in sorted(rows):
        issues = []
        for field, val in (("k", k), ("name", name)):
            if val is None or (isinstance(val, str) and not val.strip()):
                issues.append(f"Missing required field: '{field}'")
                m["missing"] += 1
        if k is not None:
            if k in seen:
                issues.append(f"Duplicate primary key 'k'={k}")
                m["dup"] += 1
            else:
                seen.add(k)
        if v is None:
            issues.append("Validator exception: v non-negative (null or non-numeric input)")
            m["rule"] += 1
        elif not v >= 0:
            issues.append("Validation failure: v non-negative")
            m["rule"] += 1
        if issues:
            m["rejected"] += 1
        out[seq] = issues
    return out, m


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_audit_matches_sequential_reference(spark, seed):
    rnd = random.Random(seed)
    n = 1500
    rows = []
    for seq in rnd.sample(range(10 * n), n):  # record order is not arrival order
        k = 42 if rnd.random() < 1 / 3 else (None if rnd.random() < 0.05 else rnd.randrange(300))
        name = rnd.choice(["a", "b", " ", "", None, "c"])
        v = rnd.choice([1, 0, -1, None, 5])
        rows.append((seq, k, name, v))
    want, m = brute_force(rows)
    df = spark.createDataFrame(rows, "seq long, k long, name string, v long").repartition(7)
    res = audit(df, "t", "k", ["k", "name"], [Rule("v non-negative", F.col("v") >= 0)], order=["seq"])
    got_m = res.metrics.first()
    assert (got_m["source_count"], got_m["rejected_count"], got_m["missing_fields_count"],
            got_m["duplicate_count"], got_m["validation_error_count"]) == \
        (n, m["rejected"], m["missing"], m["dup"], m["rule"])
    got = {r["seq"]: list(r["_rejection_reasons"]) for r in res.audited.select("seq", "_rejection_reasons").collect()}
    assert got == want
    kinds = {r["kind"]: r["issue_count"] for r in res.issue_counts().collect()}
    assert kinds.get("Duplicate primary key", 0) == m["dup"]
