import random
import time

import pytest
from pyspark.sql import functions as F

from terrace.operators.ranking import global_rank, row_number_sql, top_k_ranked


def skewed(spark, n=3000):
    # one value holds a third of the rows, many ties, some nulls
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") % 97).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("b"))


@pytest.mark.parametrize("kind", ["dense_rank", "rank"])
@pytest.mark.parametrize("order", [["-a", "b"], ["a"], ["b", "-a"]])
def test_range_rank_equals_window(spark, kind, order):
    d = skewed(spark)
    w = global_rank(d, order, out="r", kind=kind, window_rows=10**6)
    r = global_rank(d, order, out="r", kind=kind, num_partitions=5)
    assert r.count() == d.count()
    assert w.exceptAll(r).isEmpty() and r.exceptAll(w).isEmpty()


def test_range_row_number_with_total_order(spark):
    d = skewed(spark)
    order = ["-a", "b", "id"]
    w = global_rank(d, order, out="r", kind="row_number", window_rows=10**6)
    r = global_rank(d, order, out="r", kind="row_number", num_partitions=7)
    assert w.exceptAll(r).isEmpty() and r.exceptAll(w).isEmpty()


def test_range_plan_has_no_single_partition_window(spark):
    d = skewed(spark)
    r = global_rank(d, ["-a", "b"], out="r", kind="dense_rank", num_partitions=4)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_top_k_ranked(spark):
    d = skewed(spark)
    order = ["-a", "b", "id"]
    top = top_k_ranked(d, order, 25, out="r")
    w = global_rank(d, order, out="r", kind="row_number", window_rows=10**6).where("r <= 25")
    assert top.exceptAll(w).isEmpty() and w.exceptAll(top).isEmpty()
    with pytest.raises(ValueError):
        top_k_ranked(d, order, 0)


def test_range_row_number_refuses_ties(spark):
    d = skewed(spark)
    with pytest.raises(ValueError, match="total order"):
        global_rank(d, ["-a"], out="r", kind="row_number", num_partitions=3)


def test_range_rank_with_aqe_sized_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        d = skewed(spark)
        w = global_rank(d, ["-a", "b"], out="r", kind="rank", window_rows=10**6)
        r = global_rank(d, ["-a", "b"], out="r", kind="rank")  # AQE decides
        assert w.exceptAll(r).isEmpty() and r.exceptAll(w).isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_unique_row_numbers_need_no_join_and_are_checked(spark):
    d = spark.range(1000).selectExpr("id % 10 AS a", "id AS b", "cast(null as long) AS c").repartition(5)
    r = global_rank(d, ["-a", "b"], out="r", kind="row_number", num_partitions=6, keys_unique=True)
    w = global_rank(d, ["-a", "b"], out="r", kind="row_number", window_rows=1000)
    assert r.exceptAll(w).count() == 0 and r.count() == 1000
    with pytest.raises(ValueError, match="total order"):
        global_rank(d.unionAll(d.where("b = 7")), ["-a", "b"], out="r", kind="row_number", num_partitions=6, keys_unique=True)


def test_a_stated_bound_is_held(spark):
    from pyspark.errors import PySparkException
    with pytest.raises(PySparkException, match="more than the stated"):
        global_rank(spark.range(11), ["id"], window_rows=10).collect()


def _lazy(spark, df, order, kind, **kw):
    from terrace.operators import ranking
    df.createOrReplaceTempView("ranked_rows")
    text = getattr(ranking, f"{kind}_sql")("SELECT * FROM ranked_rows", df.columns, order, "r", **kw)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ranked AS {text}")
    return spark.table("ranked")


@pytest.mark.parametrize("ranges,sample", [(2, 5), (7, 40), (200, 8192)])
def test_lazy_ranks_equal_the_plain_windows(spark, ranges, sample):
    from pyspark.sql import Window
    from terrace.operators.ranking import order_columns
    # a third of the rows share all values but the id; nulls on both sides
    df = spark.range(900).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 50 = 1 THEN NULL ELSE id % 17 END AS g",
                                     "CASE WHEN id % 3 = 0 THEN 0D WHEN id % 40 = 1 THEN NULL ELSE (id % 5) / 2D END AS a").repartition(5)
    order = ["-g", "a", "k"]
    got = _lazy(spark, df, order, "row_number", ranges=ranges, sample=sample)
    want = df.withColumn("r", F.row_number().over(Window.orderBy(*order_columns(order))).cast("long"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    order = ["g", "-a"]
    got = _lazy(spark, df, order, "dense_rank", ranges=ranges, sample=sample)
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(*order_columns(order))).cast("long"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lazy_rank_has_no_window_over_all_rows(spark):
    df = spark.range(50).selectExpr("id AS k")
    assert _lazy(spark, df.where("k < 0"), ["k"], "row_number").count() == 0
    plan = _lazy(spark, df, ["-k"], "row_number")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Window")]
    over_all = [w for w in windows if "row_number" in w and "[_range" not in w]
    assert len(windows) == 2 and not over_all


def test_order_is_checked_across_gaps_and_ranges(spark):
    from terrace.operators.integrity import order_violations
    S = "r long, v long"
    assert [x["r"] for x in order_violations(spark.createDataFrame([(1, 5), (3, 9), (4, 9)], S), "r", "v").collect()] == [1]
    rng = random.Random(3)
    rows = [(r, rng.randint(0, 9)) for r in rng.sample(range(400), 150)] + [(7, None), (None, 3), (399, 1), (399, 8)]
    per = {}
    for r, v in rows:
        if r is not None:
            per.setdefault(r, []).extend([] if v is None else [v])
    ranks = sorted(per)
    for down in (True, False):
        want = [a for a, b in zip(ranks, ranks[1:]) if per[a] and per[b] and (
            max(per[b]) > min(per[a]) if down else min(per[b]) < max(per[a]))]
        got = order_violations(spark.createDataFrame(rows, S), "r", "v", down, width=4, levels=2)
        assert sorted(x["r"] for x in got.collect()) == want and want


def test_fingerprint_tells_contents_apart(spark):
    from terrace.operators.integrity import fingerprint
    S = "a string, b string, n long"
    rows = [("x", "yz", 1), ("xy", "z", 1), (None, "", 2), ("", None, 2), ("x", "yz", 1)]
    of = lambda r: tuple(fingerprint(spark.createDataFrame(r, S).repartition(3)).first())
    assert of(rows) == of(rows[::-1]) and of(rows)[0] == 5
    others = [rows[1:], rows + rows[:1], [*rows[:2], ("", None, 2), ("", None, 2), rows[4]], [("xy", "z", 1)] + rows[1:], [("x", "yz", 2)] + rows[1:]]
    assert len({of(r) for r in [rows, *others]}) == len(others) + 1
    assert of([]) == (0, "0", "0")


def test_lazy_row_numbers_do_not_compare_with_every_split_point(spark):
    """4,000 ranges cost about what two do: a row that is held against every split point makes 2,000 times the comparisons."""
    rows = "SELECT id % 7 AS a, CAST(NULLIF(id % 5, 4) AS INT) AS b, id FROM range(20000)"
    order = ["-a", "b", "id"]

    def ranked(ranges):
        began = time.time()
        got = {r["id"]: r["n"] for r in spark.sql(row_number_sql(rows, ["id"], order, "n", ranges)).collect()}
        return got, time.time() - began

    ranked(3)
    (few, least), (many, most) = ranked(2), ranked(4000)
    want = sorted(range(20000), key=lambda i: (-(i % 7), i % 5 != 4, i % 5, i))  # nulls first where ascending
    assert few == many == {i: n for n, i in enumerate(want, 1)}
    assert most < 4 * least + 4
