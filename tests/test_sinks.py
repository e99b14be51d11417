import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources import sinks


def test_bronze_lineage_and_immutability(spark, scratch):
    df = sinks.stamp_lineage(spark.createDataFrame([(1, "a")], "k long, v string"), "feed-x", "2024-01-01T00:00:00+00:00")
    r = df.first()
    assert (r["_source"], r["_ingested_at"]) == ("feed-x", "2024-01-01T00:00:00+00:00")
    path = sinks.write_bronze(df, scratch, "clubs", "b1")
    assert path.endswith("clubs_raw/batch_id=b1")
    with pytest.raises(Exception):
        sinks.write_bronze(df, scratch, "clubs", "b1")  # a batch is never overwritten
    back = sinks.read_bronze(spark, path, T.StructType([T.StructField("k", T.LongType()),
                                                       T.StructField("v", T.StringType())]))
    assert [tuple(x) for x in back.collect()] == [(1, "a")]


def test_bronze_json_array_file(spark, scratch):
    p = f"{scratch}/arr.json"
    with open(p, "w") as fh:
        fh.write('[\n  {"k": 1, "v": "a"},\n  {"k": 2}\n]\n')
    rows = sinks.read_bronze_raw(spark, p, multiline=True).collect()
    assert [dict(r["record"]) for r in rows] == [{"k": "1", "v": "a"}, {"k": "2"}]
    typed = sinks.read_bronze(spark, p, "k long, v string", multiline=True).collect()
    assert [tuple(r) for r in typed] == [(1, "a"), (2, None)]


def test_silver_formats_keep_na_form(spark, scratch):
    df = spark.createDataFrame([(1, "W-D"), (2, "N/A")], "club_id long, form string")
    paths = {fmt: sinks.write_silver(df, scratch, "standings", fmt) for fmt in ("parquet", "csv", "json")}
    schema = T.StructType([T.StructField("club_id", T.LongType()), T.StructField("form", T.StringType())])
    csv = {r["club_id"]: r["form"] for r in sinks.read_silver_csv(spark, paths["csv"], schema).collect()}
    assert csv == {1: "W-D", 2: "N/A"}  # the text N/A stays text
    assert spark.read.schema(schema).json(paths["json"]).count() == 2
    assert spark.read.parquet(paths["parquet"]).count() == 2


def test_manifest_and_report_file(spark, scratch):
    a = spark.range(3)
    b = spark.range(5)
    m = {r["dataset"]: (r["record_count"], r["path"]) for r in
         sinks.batch_manifest({"a": a, "b": b}, {"a": "/x/a"}).collect()}
    assert m == {"a": (3, "/x/a"), "b": (5, None), "total": (8, None)}
    rep = spark.createDataFrame([("PASS", 8)], "status string, source_records long")
    path = sinks.write_quality_report(rep, f"{scratch}/quality")
    assert sinks.read_quality_report(spark, path).first()["status"] == "PASS"


def test_record_index_follows_the_files(spark, scratch):
    """Files of very different sizes, packed into tasks by size: the index keeps the order of names and lines."""
    import json
    import os

    from terrace.operators.quality import RECORD_INDEX
    os.makedirs(f"{scratch}/batch")
    want = []
    for n, size in enumerate([3, 4000, 1, 0, 900, 2500]):
        with open(f"{scratch}/batch/part-{n}.json", "w") as fh:
            for i in range(size):
                want.append(f"{n}-{i}")
                fh.write(json.dumps({"k": want[-1], "pad": "x" * 40}) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("20000", "70000", "10000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            df = spark.read.schema("k string, pad string").json(f"{scratch}/batch")
            rows = {r["k"]: r[RECORD_INDEX] for r in sinks.stamp_record_index(df).select("k", RECORD_INDEX).collect()}
            assert rows == {k: i for i, k in enumerate(want)}
            some = sinks.stamp_record_index(df.where("k LIKE '4-%'")).select("k", RECORD_INDEX).collect()
            assert {r["k"]: r[RECORD_INDEX] for r in some} == {f"4-{i}": i for i in range(900)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    made = sinks.stamp_record_index(spark.range(10).repartition(1))  # not from files
    assert RECORD_INDEX in made.columns and made.count() == 10
