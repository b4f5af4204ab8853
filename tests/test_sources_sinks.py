from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortloom import session
from cohortloom.operators import tags
from cohortloom.sources import seeds, sinks, tables
from cohortloom.streaming import increments


def test_delimited_seed_with_regex_separator(spark, tmp_path):
    path = str(tmp_path / "seeds.txt")
    with open(path, "w") as out:
        out.write("id|name\n1|a\nid|name\n2|b|extra\n3\n")
    df = seeds.delimited_seeds(spark, path, ["id", "name"], "|", key="id", key_name="key")
    assert sorted((r.key, r.name) for r in df.collect()) == [("1", "a"), ("2", "b"), ("3", None)]


def test_stored_and_sql_seeds(spark):
    table = spark.createDataFrame([("u", "1\u0001x"), ("u", "-1\u0001y"), ("u", None), ("v", "2\u0001z"), ("u", "7")], "uuid string, data string")
    assert sorted((r.id is not None, r.data) for r in seeds.stored_seeds(table, "uuid", "u", 2).collect()) == [(False, "7"), (True, "1\u0001x")]
    row = seeds.sql_seeds(spark, "select 5 as a, cast(null as string) as b", index=1, separator=",").first()
    assert (row.id, row.data, row.in_a) == ("5", "5,", 5)


def test_overwrite_touches_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, day string")
    sinks.overwrite_partitions(df, path, ["day"])
    sinks.overwrite_with(spark.createDataFrame([(9,)], "id int"), path, {"day": "b"})
    assert sorted((r.id, r.day) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


def test_latest_partition_of_a_table(spark):
    df = spark.createDataFrame([(1, "20200101"), (2, "20200103"), (3, "20200102"), (4, "1000.x")], "id int, day string")
    df.write.mode("overwrite").partitionBy("day").saveAsTable("latest_partition_test")
    latest = lambda **k: [r.id for r in tables.latest_table_partition(spark, "latest_partition_test", **k).collect()]
    assert latest() == [2] and latest(upto="20200102") == [3] and latest(upto="1") == []
    assert latest(pattern=r"^\d{8}$", upto="20200101") == [1]
    assert tables.latest_partition(df, "day", upto="20200102").first().id == 3
    spark.sql("drop table latest_partition_test")


def test_report_has_header_and_order(spark, tmp_path):
    path = str(tmp_path / "report")
    sinks.report(spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "k string, n int"), path, [F.desc("n")], limit=2)
    files = list((tmp_path / "report").glob("part-*.csv"))
    assert len(files) == 1 and files[0].read_text() == "k\tn\nb\t3\nc\t2\n"


def test_kafka_records_and_view(spark):
    df = spark.createDataFrame([(1, "v1"), (None, "v1"), (3, "v2")], "id int, version string")
    assert [r.value for r in sinks.kafka_records(df).collect()] == ["1", "3"]
    assert sinks.publish_version(spark, df, "current_view", "version", "v2").collect()[0].asDict() == {"id": 3}
    assert sinks.size_based_partitions(10) == 1 and sinks.size_based_partitions(7_000_000) == 2


def test_high_water_marks_round_trip(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "s string, t int")
    marks = tables.high_water_marks(df.where("t < 5"), "s", "t")
    assert sorted((r.s, r.t) for r in tables.above_marks(df, marks, "s", "t").collect()) == [("a", 5)]
    raised = tables.raise_marks(marks, tables.high_water_marks(df, "s", "t"))
    assert {r.source: r.mark for r in raised.collect()} == {"a": 5, "b": 2}


def test_streamed_increments_equal_one_batch(spark, tmp_path):
    schema = "k string, tag string, day string, value string"
    rows = [[("a", "x", "1", "old"), ("b", "x", "1", "b1")], [("a", "x", "2", "new"), ("a", "y", "1", "y1")]]
    source = str(tmp_path / "in")
    merge = lambda old, new: tags.latest_wins(old.unionByName(new), "k")
    for batch in rows:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = increments.maintain(stream, str(tmp_path / "state"), str(tmp_path / "cp"), lambda b: tags.latest_wins(b, "k"), merge)
        query.awaitTermination(120)
    state = spark.read.parquet(str(tmp_path / "state" / "v=1"))
    expected = tags.latest_wins(spark.createDataFrame(rows[0] + rows[1], schema), "k")
    assert sorted(map(tuple, state.select("k", "tag", "day", "value").collect())) == sorted(map(tuple, expected.collect()))


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Session:
        sparkContext = Context()

        def __init__(self, value):
            self.conf = Conf(value)

    with pytest.raises(RuntimeError):
        session.shared_dir(Session(None))
    assert session.shared_dir(Session("hdfs://x/cp/")) == "hdfs://x/cp"
    assert session.shared_dir(spark)
