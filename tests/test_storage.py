import os

import pytest
from conftest import plan, rows
from pyspark import StorageLevel
from pyspark.errors import AnalysisException

from weir.operators import (
    cache,
    coalesce,
    high_water_mark,
    newer_than,
    rebalance,
    repartition,
    repartition_by,
    snapshot_as_of,
    uncache,
)
from weir.operators.layout import storage_level
from weir.scratch import checkpointed, scratch_path
from weir.sinks import (
    jdbc_write_options,
    kafka_frame,
    kafka_write_options,
    save_mode,
    write_files,
    write_parquet_with_avro_schema,
    write_table,
)
from weir.sinks.files import delta_write_options
from weir.sources import (
    decode_json,
    jdbc_read_options,
    jdbc_url,
    kafka_read_options,
    object_uri,
    read_files,
    read_table,
    synthetic_rows,
)
from weir.sources.files import avro_read_options, delta_read_options, read_options


def data_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]


@pytest.mark.parametrize(
    "fmt, codec", [("parquet", "snappy"), ("parquet", "gzip"), ("parquet", "zstd"), ("orc", "zstd"), ("csv", "gzip"), ("json", "gzip")]
)
def test_roundtrip_with_compression(spark, tmp_path, fmt, codec):
    df = spark.createDataFrame([(1, "中文"), (2, "Привет"), (3, "مرحبا"), (4, "€ü😀")], "id int, text string")
    path = str(tmp_path / "t")
    options = {"header": "true"} if fmt == "csv" else {}
    write_files(df, path, fmt, compression=codec, **options)
    assert rows(read_files(spark, path, fmt, df.schema)) == rows(df)
    ending = {"gzip": ".gz", "snappy": ".snappy", "zstd": ".zst"}[codec]
    assert all(ending in f for f in data_files(path))


def test_csv_defaults_infer_types(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1.5)], "id int, name string, v double").write.csv(path, header=True)
    assert dict(read_files(spark, path, "csv").dtypes) == {"id": "int", "name": "string", "v": "double"}
    assert set(dict(read_files(spark, path, "CSV", inferSchema=False).dtypes).values()) == {"string"}


def test_read_options():
    assert read_options("csv", {"delimiter": "|"}) == {"header": "true", "inferSchema": "true", "delimiter": "|"}
    assert "inferSchema" not in read_options("csv", {}, has_schema=True)
    assert read_options("json", {"multiLine": True, "inferSchema": None}) == {"multiLine": "true"}
    assert read_options("parquet", {}) == {}
    with pytest.raises(ValueError, match="unknown file format"):
        read_options("xml", {})
    assert delta_read_options(3, "2025-01-01") == {"versionAsOf": "3"}
    assert delta_read_options(0) == {"versionAsOf": "0"}
    assert delta_read_options(timestamp="2025-01-01") == {"timestampAsOf": "2025-01-01"}
    assert delta_read_options() == {}
    assert avro_read_options('{"type":"record"}', True) == {"avroSchema": '{"type":"record"}', "inferSchema": "true"}
    assert delta_write_options(True, None) == {"mergeSchema": "true"}


@pytest.mark.parametrize("path", ["/in/users", "in/users"])
def test_object_uri_joins_with_one_slash(path):
    assert object_uri("bucket", path) == "s3a://bucket/in/users"


def test_save_modes(spark, tmp_path):
    a, b = spark.range(10), spark.range(3)
    path = str(tmp_path / "t")
    write_files(a, path, mode="ErrorIfExists")
    with pytest.raises(AnalysisException):
        write_files(b, path, mode="errorifexists")
    write_files(b, path, mode="ignore")
    assert read_files(spark, path).count() == 10
    write_files(b, path, mode="append")
    assert read_files(spark, path).count() == 13
    write_files(b, path, mode="OVERWRITE")
    assert read_files(spark, path).count() == 3
    with pytest.raises(ValueError, match="unknown save mode"):
        save_mode("upsert")


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "id % 4 as k")
    write_files(df, path, partition_by="k")
    kept = read_files(spark, path).filter("k = 2")
    assert kept.count() == 250
    assert "PartitionFilters: [isnotnull(k" in plan(kept)


def test_balanced_write_leaves_few_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 4 as k")
    write_files(df, str(tmp_path / "wide"), partition_by="k")
    write_files(df, str(tmp_path / "even"), partition_by="k", balance=True)
    assert len(data_files(tmp_path / "wide")) == 32
    assert len(data_files(tmp_path / "even")) == 4
    assert rows(read_files(spark, str(tmp_path / "even"))) == rows(read_files(spark, str(tmp_path / "wide")))


def test_balanced_write_splits_a_hot_value(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    df = spark.range(0, 200_000, 1, 8).selectExpr("id", "if(id % 10 = 0, id % 3, 7) as k")
    write_files(df, str(tmp_path / "t"), partition_by="k", balance=True)
    assert len(data_files(tmp_path / "t" / "k=7")) > 1
    sizes = [spark.read.parquet(f).count() for f in data_files(tmp_path / "t" / "k=7")]
    assert max(sizes) < 180_000 / 2
    assert read_files(spark, str(tmp_path / "t")).count() == 200_000


def test_parquet_keeps_its_avro_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 5)], "id int, name string, k int")
    write_parquet_with_avro_schema(df, path, partition_by="k")
    stored = spark.read.parquet(path)
    assert '"name":"name"' in stored.schema["id"].metadata["avroSchema"]
    assert rows(stored) == [(1, "a", 5)]


def test_jdbc_options():
    url = jdbc_url("postgres", "db", "shop")
    assert url == "jdbc:postgresql://db:5432/shop"
    assert jdbc_url("mysql", "db", "shop", 3307) == "jdbc:mysql://db:3307/shop"
    plain = jdbc_read_options(url, table="users", user="u", password="p", driver="org.postgresql.Driver")
    assert plain == {"url": url, "driver": "org.postgresql.Driver", "user": "u", "password": "p", "dbtable": "users"}
    assert jdbc_read_options(url, table="users", query="select 1")["query"] == "select 1"
    split = jdbc_read_options(url, query="select * from t", partition_column="id", properties={"ssl": "true"})
    assert split["dbtable"] == "(select * from t) t" and "query" not in split
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("0", "1000000", "10")
    assert split["ssl"] == "true"
    with pytest.raises(ValueError, match="table or a query"):
        jdbc_read_options(url)
    assert jdbc_write_options(url, "out", user="u", batch_size="5000") == {
        "url": url, "dbtable": "out", "user": "u", "batchsize": "5000",
    }
    assert jdbc_write_options(url, "out")["batchsize"] == "1000"


def test_kafka_options():
    assert kafka_read_options("t") == {
        "subscribe": "t", "startingOffsets": "earliest", "kafka.bootstrap.servers": "localhost:9092",
    }
    secure = kafka_read_options(
        "t", properties={"bootstrap.servers": "b:1", "security.protocol": "SSL"}, endingOffsets="latest", minPartitions=4
    )
    assert secure == {
        "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest",
        "kafka.bootstrap.servers": "b:1", "kafka.security.protocol": "SSL",
    }
    stream = kafka_read_options("t", streaming=True, endingOffsets="latest", maxOffsetsPerTrigger=5)
    assert stream == {
        "subscribe": "t", "startingOffsets": "latest", "maxOffsetsPerTrigger": "5",
        "minPartitions": "1", "kafka.bootstrap.servers": "localhost:9092",
    }
    assert kafka_write_options("t", "b:1") == {"topic": "t", "kafka.bootstrap.servers": "b:1"}


def test_kafka_frame(spark):
    both = spark.createDataFrame([("k", "v", 1)], "key string, value string, x int")
    assert rows(kafka_frame(both)) == [("k", "v")]
    plain = spark.createDataFrame([(1, None), (2, "b")], "id int, name string")
    assert rows(kafka_frame(plain)) == [(None, '{"id":1}'), (None, '{"id":2,"name":"b"}')]
    keyed = spark.createDataFrame([(7, "a")], "key int, name string")
    assert rows(kafka_frame(keyed)) == [("7", '{"key":7,"name":"a"}')]
    assert kafka_frame(keyed).columns == ["key", "value"]


def test_decode_json(spark):
    messages = spark.createDataFrame(
        [(b'{"user_id":1,"event_type":"buy","amount":9.5}',), (b'{"user_id":2}',), (b"not json",)], "value binary"
    )
    out = decode_json(messages, "user_id int, event_type string, amount double")
    assert rows(out) == sorted([(1, "buy", 9.5), (2, None, None), (None, None, None)], key=lambda r: tuple(map(repr, r)))


def test_incremental(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"), (4, None)], "id int, d string")
    df = df.selectExpr("id", "cast(d as date) as d")
    seen = df.filter("id <= 2").select("d")
    assert rows(newer_than(df, "d", seen, "d").select("id")) == [(3,)]
    assert rows(newer_than(df, "d", seen.filter("false"), "d")) == []
    assert newer_than(df, "d", seen.filter("false"), "d", initial="1900-01-01").count() == 3
    assert str(high_water_mark(df, "d").first().last_processed) == "2024-01-03"


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(newer_than(df, "id", df.filter("id < 90"), "id"))
    assert "GreaterThan(id,ScalarSubquery" in text


def test_snapshot_as_of(spark):
    log = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, "z"), ("b", 3, 1, "w"), ("c", 9, 1, None)],
        "k string, t int, seq int, v string",
    )
    assert rows(snapshot_as_of(log, "k", ["t", "seq"])) == [("a", 2, 2, "z"), ("b", 3, 1, "w"), ("c", 9, 1, None)]
    assert rows(snapshot_as_of(log, "k", ["t", "seq"], 2)) == [("a", 2, 2, "z")]
    assert snapshot_as_of(log, ["k"], ["t", "seq"], 1).columns == log.columns
    assert "partial_max_by" in plan(snapshot_as_of(log, "k", ["t", "seq"]))


def test_layout(spark):
    df = spark.range(0, 50, 1, 3).selectExpr("id", "id % 5 as k")
    assert repartition(df, "8").rdd.getNumPartitions() == 8
    assert repartition_by(df, "k", 6).rdd.getNumPartitions() == 6
    assert coalesce(df, 2).rdd.getNumPartitions() == 2
    assert coalesce(df, "9").rdd.getNumPartitions() == 3
    spread = repartition_by(df, ["k"], 6).selectExpr("k", "spark_partition_id() as p").distinct()
    assert spread.count() == 5
    for moved in (repartition(df, 8), repartition_by(df, ["k"]), coalesce(df, 1), rebalance(df, "k")):
        assert rows(moved) == rows(df)
    with pytest.raises(ValueError):
        repartition_by(df, [])


def test_cache_levels(spark):
    df = spark.range(10)
    assert storage_level("memory_only_ser") == StorageLevel.MEMORY_ONLY
    assert storage_level("no such level") == StorageLevel.MEMORY_AND_DISK
    held = cache(df, "DISK_ONLY")
    assert held.count() == 10 and held.storageLevel == StorageLevel.DISK_ONLY
    uncache(held, blocking=True)
    assert not held.storageLevel.useDisk


def test_scratch_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second
    cut = checkpointed(spark.range(10).filter("id > 3"))
    assert cut.count() == 6 and "Range" not in plan(cut)
    assert spark.sparkContext.getCheckpointDir().startswith(f"file:{root}")


def test_synthetic_rows(spark):
    df = synthetic_rows(spark, 10_000, partitions=4)
    assert df.columns == ["id", "category", "value1", "value2", "created_at"]
    assert df.select("category").distinct().count() == 1000
    assert df.filter("value1 < 0 or value1 >= 1000 or value2 >= 100").count() == 0
    assert df.select("value1").limit(5).collect() == df.select("value1").limit(5).collect()


def test_parquet_table_merges_schemas_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(2), path, table_format="parquet", merge_schema="true")
    write_table(spark.range(2, 3).selectExpr("id", "'n' as note"), path, table_format="parquet")
    merged = read_table(spark, path, table_format="parquet", merge_schema=True)
    assert rows(merged) == [(0, None), (1, None), (2, "n")]
    with pytest.raises(ValueError, match="as of"):
        read_table(spark, path, version=1, table_format="parquet")
