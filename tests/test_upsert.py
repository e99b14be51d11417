import pytest
from pyspark.sql import functions as F

from terrace.operators.upsert import DuplicateBatchKey, upsert, upsert_counts
from terrace.sources.warehouse import IntegrityError, Warehouse

P = "player_id long, club_id long, goals int"


def test_upsert_insert_update_keep(spark):
    target = spark.createDataFrame([(1, 1, 5), (2, 1, 6)], P)
    batch = spark.createDataFrame([(2, 1, 9), (3, 1, 1)], P)
    got = sorted(tuple(r) for r in upsert(target, batch, "player_id").collect())
    assert got == [(1, 1, 5), (2, 1, 9), (3, 1, 1)]
    c = upsert_counts(target, batch, "player_id").first()
    assert (c["processed"], c["inserted"], c["updated"]) == (2, 1, 1)


def test_upsert_idempotent(spark):
    target = spark.createDataFrame([(i, 1, i) for i in range(20)], P)
    once = upsert(target, target, "player_id")
    twice = upsert(once, target, "player_id")
    thrice = upsert(twice, target, "player_id")
    assert thrice.count() == 20
    assert thrice.exceptAll(target).isEmpty() and target.exceptAll(thrice).isEmpty()


def test_in_place_mutation(spark):
    target = spark.createDataFrame([(111, 5, 27), (112, 5, 3)], P)
    out = upsert(target, spark.createDataFrame([(111, 5, 29)], P), "player_id")
    assert out.count() == 2 and out.where("player_id = 111").first()["goals"] == 29


def test_duplicate_batch_key_raises(spark):
    target = spark.createDataFrame([(1, 1, 5)], P)
    with pytest.raises(DuplicateBatchKey):
        upsert(target, spark.createDataFrame([(2, 1, 1), (2, 1, 2)], P), "player_id")


def test_warehouse_publish_versions_and_rollback(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh")
    clubs = spark.createDataFrame([(1, "A", "AAA", "S", 10, "C", 1900, "#fff", "t")],
                                  "club_id long, name string, short_name string, stadium string, capacity int, "
                                  "city string, founded_year int, primary_color string, transformed_at string")
    v1 = wh.publish({"clubs": clubs})
    assert v1["version"] == 1 and wh.read("clubs").count() == 1
    # three identical loads keep identical content (idempotency)
    for _ in range(2):
        cur = wh.read("clubs")
        wh.publish({"clubs": upsert(cur, clubs, "club_id")})
    assert wh.current()["version"] == 3 and wh.read("clubs").count() == 1
    # a batch that breaks a constraint is staged but never published
    bad = clubs.withColumn("capacity", F.lit(0))
    with pytest.raises(IntegrityError):
        wh.publish({"clubs": bad})
    assert wh.current()["version"] == 3 and wh.read("clubs").first()["capacity"] == 10
    wh.drop("clubs")
    assert not wh.exists("clubs")


@pytest.mark.parametrize("bound", [10, None])
def test_surrogate_keys_stable(spark, bound):
    from terrace.operators.upsert import assign_surrogate_keys
    b1 = spark.createDataFrame([(30,), (10,)], "club_id long")
    v1 = assign_surrogate_keys(None, b1, "club_id", window_rows=bound)
    assert sorted(tuple(r) for r in v1.collect()) == [(10, 1), (30, 2)]
    b2 = spark.createDataFrame([(20,), (10,), (40,)], "club_id long")
    v2 = assign_surrogate_keys(v1, b2, "club_id", window_rows=bound)
    assert sorted(tuple(r) for r in v2.collect()) == [(10, 1), (20, 3), (40, 4)]


def test_publish_checks_batch_against_staged_parents(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh2")
    clubs = spark.createDataFrame([(1, "A", "AAA", "S", 10, "C", 1900, "#fff", "t")],
                                  "club_id long, name string, short_name string, stadium string, capacity int, "
                                  "city string, founded_year int, primary_color string, transformed_at string")
    wh.publish({"clubs": clubs}, batches={"clubs": clubs})
    P2 = ("player_id long, club_id long, name string, position string, nationality string, jersey_number int, "
          "appearances int, goals int, assists int, goal_contributions int, goals_per_game double, transformed_at string")
    ok = spark.createDataFrame([(10, 1, "p", "Forward", "X", 9, 1, 1, 0, 1, 1.0, "t")], P2)
    wh.publish({"players": ok}, batches={"players": ok})
    orphan = spark.createDataFrame([(11, 7, "q", "Forward", "X", 9, 1, 1, 0, 1, 1.0, "t")], P2)
    with pytest.raises(IntegrityError, match="fk_players_club"):
        wh.publish({"players": upsert(wh.read("players"), orphan, "player_id")}, batches={"players": orphan})
    assert wh.read("players").count() == 1


def test_publish_unique_against_existing_rows(spark, scratch):
    wh = Warehouse(spark, f"{scratch}/wh3")
    C = ("club_id long, name string, short_name string, stadium string, capacity int, city string, "
         "founded_year int, primary_color string, transformed_at string")
    a = spark.createDataFrame([(1, "A", "AAA", "S", 10, "C", 1900, "#fff", "t")], C)
    wh.publish({"clubs": a}, batches={"clubs": a})
    b = spark.createDataFrame([(2, "A", "BBB", "S", 10, "C", 1900, "#fff", "t")], C)  # same name, new key
    with pytest.raises(IntegrityError, match="unique_name_staged"):
        wh.publish({"clubs": upsert(wh.read("clubs"), b, "club_id")}, batches={"clubs": b})
    assert wh.read("clubs").count() == 1


def test_bucketed_upserts_rewrite_touched_buckets_only(spark, scratch):
    import glob
    import random
    from terrace.schemas import TableSpec
    specs = {"items": TableSpec("items", ["k"], not_null=["k"])}
    wh = Warehouse(spark, f"{scratch}/wh4", specs=specs, buckets=8)
    S = "k long, v long"
    base = spark.createDataFrame([(i, 0) for i in range(200)], S)
    wh.publish({"items": base})
    expect = {i: 0 for i in range(200)}
    rnd = random.Random(7)
    for step in range(1, 6):
        keys = rnd.sample(range(260), 5)
        batch = spark.createDataFrame([(k, step) for k in keys], S)
        info = wh.publish_upserts({"items": batch})
        for k in keys:
            expect[k] = step
        got = {r["k"]: r["v"] for r in wh.read("items").collect()}
        assert got == expect
        if step == 1:
            written = glob.glob(f"{scratch}/wh4/items/layer=v{info['version']}-*/terrace_bucket=*")
            assert 0 < len(written) <= 5  # only the touched buckets were rewritten
    assert len(set(wh.current()["tables"]["items"]["owners"])) > 1
    wh.compact("items", buckets=3)
    entry = wh.current()["tables"]["items"]
    assert len(set(entry["owners"])) == 1 and entry["buckets"] == len(entry["owners"]) == 3
    assert {r["k"]: r["v"] for r in wh.read("items").collect()} == expect
    with pytest.raises(DuplicateBatchKey):
        wh.publish_upserts({"items": spark.createDataFrame([(1, 1), (1, 2)], S)})


def test_bucket_write_one_file_per_bucket(spark, scratch):
    import glob
    from terrace.schemas import TableSpec
    wh = Warehouse(spark, f"{scratch}/wh5", specs={"items": TableSpec("items", ["k"])}, buckets=4)
    wh.publish({"items": spark.range(2000).selectExpr("id AS k", "id % 7 AS v").repartition(9)})
    files = glob.glob(f"{scratch}/wh5/items/layer=v1-*/terrace_bucket=*/*.parquet")
    assert len(files) == 4 and wh.read("items").count() == 2000


def test_loads_go_on_after_a_rejected_batch(spark, scratch):
    from terrace.schemas import TableSpec
    specs = {"items": TableSpec("items", ["k"], not_null=["k"], checks={"positive": "v >= 0"})}
    wh = Warehouse(spark, f"{scratch}/wh6", specs=specs, buckets=4)
    S = "k long, v long"
    wh.publish_upserts({"items": spark.createDataFrame([(i, i) for i in range(10)], S)})
    with pytest.raises(IntegrityError):
        wh.publish_upserts({"items": spark.createDataFrame([(1, -5), (99, 1)], S)})
    expect = {i: i for i in range(10)}
    for step in range(3):
        wh.publish_upserts({"items": spark.createDataFrame([(step, 100 + step)], S)})
        expect[step] = 100 + step
        assert {r["k"]: r["v"] for r in wh.read("items").collect()} == expect
    assert wh.current()["version"] == 4


def test_bucket_count_is_kept_with_the_table(spark, scratch):
    from terrace.schemas import TableSpec
    specs = {"items": TableSpec("items", ["k"])}
    S = "k long, v long"
    Warehouse(spark, f"{scratch}/wh7", specs=specs, buckets=4).publish({"items": spark.createDataFrame([(i, 0) for i in range(20)], S)})
    again = Warehouse(spark, f"{scratch}/wh7", specs=specs, buckets=7)
    again.publish_upserts({"items": spark.createDataFrame([(1, 9)], S)})
    assert {r["k"]: r["v"] for r in again.read("items").collect()} == {i: 9 if i == 1 else 0 for i in range(20)}
    assert again.read("items").count() == 20


def test_an_unreadable_manifest_is_no_empty_warehouse(spark, scratch):
    import os
    wh = Warehouse(spark, f"{scratch}/wh8")
    assert wh.current()["version"] == 0
    os.makedirs(f"{scratch}/wh8/_versions/version=1")
    with open(f"{scratch}/wh8/_versions/version=1/manifest.json", "w") as fh:
        fh.write('{"version": "one"')
    with pytest.raises(Exception, match="malformed manifest"):
        wh.current()


def test_duplicate_batch_keys_are_counted(spark):
    d = spark.createDataFrame([(i // 2, 0) for i in range(40)], "player_id long, v long")
    with pytest.raises(DuplicateBatchKey, match="20 duplicate keys"):
        upsert(d, d, "player_id")


ITEMS = "k long, v long"


def _items(spark, root, buckets=8):
    from terrace.schemas import TableSpec
    specs = {"items": TableSpec("items", ["k"], unique=[["v"]], not_null=["k"])}
    return Warehouse(spark, root, specs=specs, buckets=buckets)


def _rows(wh):
    return {r["k"]: r["v"] for r in wh.read("items").collect()}


def test_two_writers_from_one_version_are_both_kept(spark, scratch):
    """The second writer publishes while the first has staged and not yet claimed its version."""
    first, second = _items(spark, f"{scratch}/w"), _items(spark, f"{scratch}/w")
    first.publish_upserts({"items": spark.createDataFrame([(i, i) for i in range(40)], ITEMS)})
    check, staged = first._check, []

    def meanwhile(state, batches):
        staged.append(state)
        if len(staged) == 1:
            second.publish_upserts({"items": spark.createDataFrame([(2, 200), (100, 1000)], ITEMS)})
        check(state, batches)

    first._check = meanwhile
    info = first.publish_upserts({"items": spark.createDataFrame([(2, 300), (3, 301), (101, 1001)], ITEMS)})
    assert info["version"] == 3 and len(staged) == 2  # key 2 is in a bucket of both: staged again
    assert _rows(second) == {i: i for i in range(40)} | {2: 300, 3: 301, 100: 1000, 101: 1001}
    assert [_rows(first) for _ in range(3)] == [_rows(second)] * 3


def test_a_writer_of_other_buckets_is_put_on_top(spark, scratch):
    wh, other = _items(spark, f"{scratch}/w", 64), _items(spark, f"{scratch}/w", 64)
    wh.publish_upserts({"items": spark.createDataFrame([(i, i) for i in range(40)], ITEMS)})
    bucket = {r["k"]: r["b"] for r in spark.range(40).withColumnRenamed("id", "k").select("k", wh._bucket("items", 64).alias("b")).collect()}
    a = 0
    b = next(k for k in bucket if bucket[k] != bucket[a])
    check, seen, writes, write = wh._check, [], [], wh._write

    def meanwhile(state, batches):
        seen.append(1)
        if len(seen) == 1:
            other.publish_upserts({"items": spark.createDataFrame([(b, 500)], ITEMS)})
        check(state, batches)

    wh._check, wh._write = meanwhile, lambda *x: (writes.append(1), write(*x))
    assert wh.publish_upserts({"items": spark.createDataFrame([(a, 600)], ITEMS)})["version"] == 3
    assert len(seen) == 2 and len(writes) == 1  # checked again on the new state, written once
    assert _rows(wh)[a] == 600 and _rows(wh)[b] == 500
    # each value alone is unique, together they are not: the check on the new state finds it
    seen.clear()
    other.publish_upserts({"items": spark.createDataFrame([(b, 501)], ITEMS)})

    def clash(state, batches):
        seen.append(1)
        if len(seen) == 1:
            other.publish_upserts({"items": spark.createDataFrame([(b, 700)], ITEMS)})
        check(state, batches)

    wh._check = clash
    with pytest.raises(IntegrityError, match="unique"):
        wh.publish_upserts({"items": spark.createDataFrame([(a, 700)], ITEMS)})
    assert _rows(wh)[a] == 600 and _rows(wh)[b] == 700


def test_a_replaced_table_is_a_conflict(spark, scratch):
    from terrace.sources.warehouse import ConflictError
    wh, other = _items(spark, f"{scratch}/w"), _items(spark, f"{scratch}/w")
    wh.publish({"items": spark.createDataFrame([(1, 1)], ITEMS)})
    check, seen = wh._check, []

    def meanwhile(state, batches):
        seen.append(1)
        other.publish_upserts({"items": spark.createDataFrame([(2, 2)], ITEMS)})
        check(state, batches)

    wh._check = meanwhile
    with pytest.raises(ConflictError):
        wh.publish({"items": spark.createDataFrame([(3, 3)], ITEMS)})
    assert _rows(other) == {1: 1, 2: 2} and len(seen) == 1


def test_many_writers_at_once(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    _items(spark, f"{scratch}/w").publish_upserts({"items": spark.createDataFrame([(0, 0)], ITEMS)})

    def load(i):
        return _items(spark, f"{scratch}/w").publish_upserts(
            {"items": spark.createDataFrame([(10 * i + j, 10 * i + j) for j in range(3)], ITEMS)})["version"]

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(load, range(1, 5)))
    assert sorted(versions) == [2, 3, 4, 5]
    assert _rows(_items(spark, f"{scratch}/w")) == {0: 0} | {10 * i + j: 10 * i + j for i in range(1, 5) for j in range(3)}


def test_old_manifests_go_and_live_views_follow(spark, scratch, monkeypatch):
    """V9: views are made once; whatever is published later is seen, in a native scan with pruned columns."""
    from terrace.sources import warehouse
    monkeypatch.setattr(warehouse, "HISTORY", 3)
    wh = _items(spark, f"{scratch}/w")
    wh.publish_upserts({"items": spark.createDataFrame([(i, i) for i in range(20)], ITEMS)})
    assert wh.create_live_views("live_") == ["live_items"]
    view = lambda: {r["k"]: r["v"] for r in spark.table("live_items").collect()}
    for step in range(5):
        wh.publish_upserts({"items": spark.createDataFrame([(step, 100 + step), (50 + step, 300 + step)], ITEMS)})
        assert view() == _rows(wh) and view()[step] == 100 + step
    wh.compact("items", buckets=3)
    assert view() == _rows(wh) and len(view()) == 25
    assert wh._versions() == [5, 6, 7]
    plan = spark.sql("SELECT v FROM live_items")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<v:bigint>" in plan and "dynamicpruning" in plan
    wh.drop("items")
    assert view() == {}
    spark.catalog.dropTempView("live_items")


def test_defaults_are_applied_when_loading(spark, scratch):
    from terrace.schemas import TableSpec
    wh = Warehouse(spark, f"{scratch}/w", specs={"items": TableSpec("items", ["k"], not_null=["v"], defaults={"v": 7})})
    wh.publish_upserts({"items": spark.createDataFrame([(1, 1), (2, None)], ITEMS)})
    wh.publish_upserts({"items": spark.createDataFrame([(3,)], "k long")})
    assert _rows(wh) == {1: 1, 2: 7, 3: 7}
