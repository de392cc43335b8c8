import json
import os

import pytest
from conftest import rows
from weir.operators import SchemaMismatch, ValidationFailed
from weir.plans import run_steps
from weir.plans.composer import _jdbc, Run


def step(kind, method, **config):
    return {"type": kind, "method": method, "config": config}


def spec(*steps, mode="batch"):
    return {"name": "test", "mode": mode, "steps": list(steps)}


@pytest.fixture
def pumps(spark, tmp_path):
    path = str(tmp_path / "pumps")
    spark.createDataFrame(
        [(1, "lock", 340, "on"), (2, "ford", 90, "on"), (3, "dam", 510, "idle"), (4, "mole", 280, "on"), (5, "quay", 300, "idle")],
        "pump_id int, site string, flow int, state string",
    ).write.parquet(path)
    return path


def s3(path, **more):
    return {"bucket": "", "path": path, "scheme": "file", **more}


def test_extract_transform_validate_load(spark, pumps, tmp_path):
    out = str(tmp_path / "out")
    run = run_steps(
        spark,
        json.loads(json.dumps(spec(
            step("extract", "fromS3", **s3(pumps, registerAs="pumps")),
            step("transform", "filterRows", condition="state = 'on'"),
            step("transform", "enrichData", columns={"strong": "flow >= 200"}),
            step("validate", "validateNulls", notNullColumns=["pump_id"]),
            step("validate", "validateRanges", ranges={"flow": {"min": 1, "max": 600}}),
            step("validate", "validateBusinessRules", rules=["site <> ''"]),
            step("transform", "filterRows", condition="strong"),
            step("load", "toS3", **s3(out, mode="overwrite", compression="gzip", partitionBy="state")),
            step("load", "toS3", **s3(out + "-json", format="json")),
        ))),
    )
    assert rows(spark.read.parquet(out).select("pump_id", "strong")) == [(1, True), (4, True)]
    assert spark.read.json(out + "-json").count() == 2
    assert os.path.isdir(f"{out}/state=on")
    loads = [m for m in run.metrics if m["type"] == "load"]
    assert [m["records"] for m in loads] == [2, 2]
    assert [m["step"] for m in run.metrics] == list(range(9))
    assert run.frames["pumps"].count() == 5


def test_table_folders_and_empty_loads(spark, pumps, tmp_path):
    out = str(tmp_path / "table")
    load = step("load", "toDeltaLake", path=out, tableFormat="parquet", partitionBy=["state"])
    empty = step("transform", "filterRows", condition="flow > 10000")
    grouped = step("transform", "aggregateData", groupBy=["state"], aggregations={"flow": "max"})
    again = step("extract", "fromDeltaLake", path=out, tableFormat="parquet")
    first = step("extract", "fromS3", **s3(pumps))
    run = run_steps(spark, spec(first, load, again, grouped))
    assert rows(run.current()) == [("idle", 510), ("on", 340)]
    run = run_steps(spark, spec(first, empty, load, grouped, load))
    assert [m["records"] for m in run.metrics if m["type"] == "load"] == [0, 0]
    skipped = step("load", "toS3", **s3(out, mode="ignore"))
    assert run_steps(spark, spec(first, skipped)).metrics[-1]["records"] is None


def test_neighbouring_checks_fail_together(spark, pumps):
    with pytest.raises(ValidationFailed) as error:
        run_steps(
            spark,
            spec(
                step("extract", "fromS3", **s3(pumps)),
                step("validate", "validateRanges", ranges={"flow": [100, 500]}),
                step("validate", "validateBusinessRules", rules=["state = 'on'"]),
            ),
        )
    assert [f["violations"] for f in error.value.failures] == [1, 1, 2]


def test_violations_can_filter_instead(spark, pumps):
    run = run_steps(
        spark,
        spec(
            step("extract", "fromS3", **s3(pumps)),
            step("validate", "validateRanges", ranges={"flow": [100, 500]}, onViolation="filter"),
        ),
    )
    assert rows(run.current().select("pump_id")) == [(1,), (4,), (5,)]


def test_joins_unions_and_the_registry(spark, wells):
    orders = spark.createDataFrame([(1, 4.5), (1, 0.5), (3, 8.0)], "id int, amount double")
    frames = {"wells": wells, "orders": orders}
    by_condition = step(
        "transform", "joinDataFrames", inputDataFrames=["wells", "orders"],
        joinConditions=["wells.id = orders.id"], registerAs="both",
    )
    by_column = step("transform", "joinDataFrames", inputDataFrames=["wells", "orders"], joinColumn="id", broadcast=True)
    by_key = step("transform", "joinDataFrames", inputDataFrames=["wells", "orders"], joinKey="id", joinType="left")
    total = step("transform", "aggregateData", groupBy=["label"], aggregations={"amount": "sum"})
    want = [("north", 5.0), ("quarry", 8.0)]
    run = run_steps(spark, spec(by_condition, total), frames)
    assert rows(run.current()) == want and run.frames["both"].count() == 3
    assert rows(run_steps(spark, spec(by_column, total), frames).current()) == want
    assert run_steps(spark, spec(by_key), frames).current().count() == 4
    union = step("transform", "unionDataFrames", inputDataFrames=["wells"])
    assert run_steps(spark, spec(union), frames, wells).current().count() == 6
    alone = step("transform", "unionDataFrames", inputDataFrames=["wells"], includePrimary=False)
    assert run_steps(spark, spec(alone), frames, wells).current().count() == 3
    same = step("transform", "joinDataFrames", inputDataFrames=["wells", "nobody"], joinColumn="id")
    with pytest.raises(KeyError, match="nobody"):
        run_steps(spark, spec(same), frames)


def test_references_and_schema(spark, wells):
    orders = spark.createDataFrame([(1,), (7,)], "id int")
    check = step(
        "validate", "validateReferentialIntegrity", foreignKey="id", referencedDataFrame="wells", referencedColumn="id"
    )
    with pytest.raises(ValidationFailed, match="id in id: 1"):
        run_steps(spark, spec(check), {"wells": wells}, orders)
    assert run_steps(spark, spec(check), {"wells": wells}, wells.select("id")).current().count() == 3
    schema = step("validate", "validateSchema", expectedColumns=[{"name": "id", "type": "long"}])
    with pytest.raises(SchemaMismatch):
        run_steps(spark, spec(schema), primary=orders)


def test_reshape_evolve_and_layout_steps(spark, catches):
    pivoted = step(
        "transform", "reshapeData", operation="pivot", pivotColumn="species", groupByColumns=["harbour"],
        aggregateColumn="kilos",
    )
    long = step(
        "transform", "reshapeData", operation="unpivot", valueCols=["cod", "hake", "ling"], variableColName="species",
        valueColName="kilos",
    )
    target = json.dumps({"type": "record", "name": "R", "fields": [
        {"name": "harbour", "type": "string"}, {"name": "kilos", "type": "double"}, {"name": "note", "type": "string"}]})
    run = run_steps(
        spark,
        spec(
            pivoted, long, step("transform", "evolveAvroSchema", targetSchema=target),
            step("transform", "repartition", numPartitions="3"),
            step("transform", "repartitionByColumns", columns="harbour", numPartitions=2),
            step("transform", "coalesce", numPartitions=1, cache="true", cacheStorageLevel="MEMORY_ONLY_SER"),
        ),
        primary=catches,
    )
    out = run.current()
    assert out.columns == ["harbour", "kilos", "note"] and out.rdd.getNumPartitions() == 1
    assert out.storageLevel.useMemory and not out.storageLevel.useDisk
    assert sorted(r.kilos for r in out.collect() if r.kilos) == [7.0, 15.5, 20.0]
    text = run_steps(spark, spec(step("transform", "toAvroSchema", name="Landing")), primary=catches).current().first()[0]
    assert json.loads(text)["name"] == "Landing"


def test_streaming_mode(spark, pumps, tmp_path):
    stream = spark.readStream.schema(spark.read.parquet(pumps).schema).parquet(pumps)
    out = str(tmp_path / "out")
    run = run_steps(
        spark,
        spec(
            step("transform", "filterRows", condition="flow >= 100"),
            step("validate", "validateBusinessRules", rules=["state = 'on'"], onViolation="filter"),
            step("load", "toS3", **s3(out, trigger="once", checkpointLocation=str(tmp_path / "ck"), queryName="strong")),
            mode="streaming",
        ),
        primary=stream,
    )
    run.queries["strong"].awaitTermination(60)
    assert rows(spark.read.parquet(out).select("pump_id")) == [(1,), (4,)]
    with pytest.raises(ValueError, match="onViolation"):
        run_steps(
            spark, spec(step("validate", "validateNulls", notNullColumns=["flow"]), mode="streaming"), primary=stream
        )


def test_input_errors(spark, wells):
    for broken, message in [
        (spec(step("extract", "fromMars")), "unknown extract method"),
        (spec(step("transform", "teleport")), "unknown transform method"),
        (spec(step("validate", "validateMood")), "unknown validation method"),
        (spec(step("load", "toMars")), "unknown load method"),
        (spec(step("travel", "far")), "step type"),
        (spec(), "at least one step"),
        ({"mode": "sometimes", "steps": [step("load", "toS3")]}, "mode is one of"),
        (spec(step("transform", "filterRows", condition="id > 0; drop")), "second statement"),
        (spec(step("validate", "validateBusinessRules", rules=["id > 0 -- x"])), "comment"),
    ]:
        with pytest.raises(ValueError, match=message):
            run_steps(spark, broken, primary=wells)
    with pytest.raises(ValueError, match="no frame yet"):
        run_steps(spark, spec(step("transform", "filterRows", condition="true")))


def test_credentials_become_options(spark):
    secrets = {"secret/pg": {"host": "db", "port": 5433, "database": "shop", "username": "u", "password": "p"}}
    run = Run(spark, credentials=secrets)
    options = _jdbc(run, "fromPostgres", {"credentialPath": "secret/pg"})
    assert options["url"] == "jdbc:postgresql://db:5433/shop"
    assert options["driver"] == "org.postgresql.Driver" and options["user"] == "u"
    assert _jdbc(run, "toMySQL", {"url": "jdbc:mysql://m/x"})["url"] == "jdbc:mysql://m/x"


def test_connector_steps_pass_their_options(spark, wells, monkeypatch):
    """No connection is made: the connector functions only record their arguments."""
    seen = {}

    def record(name, result):
        def call(*args, **kwargs):
            seen[name] = (args[1:], kwargs)
            return result

        return call

    from weir import sinks, sources

    monkeypatch.setattr(sources, "read_jdbc", record("read_jdbc", wells))
    monkeypatch.setattr(sources, "read_kafka", record("read_kafka", wells.selectExpr("to_json(struct(*)) as value")))
    monkeypatch.setattr(sources, "read_table", record("read_table", wells))
    monkeypatch.setattr(sources, "read_avro", record("read_avro", wells))
    monkeypatch.setattr(sinks, "write_jdbc", record("write_jdbc", None))
    monkeypatch.setattr(sinks, "write_kafka", record("write_kafka", None))
    secrets = {
        "pg": {"host": "db", "database": "shop", "username": "u", "password": "p"},
        "kafka": {"bootstrap.servers": "b:1", "security.protocol": "SSL"},
    }
    run = run_steps(
        spark,
        spec(
            step("extract", "fromPostgres", query="select 1", credentialPath="pg", partitionColumn="id", numPartitions=20),
            step("extract", "fromKafka", topic="t", credentialPath="kafka", endingOffsets="latest", schema="id int, depth int"),
            step("extract", "fromDeltaLake", path="/d", version=3),
            step("extract", "fromAvro", path="/a", avroSchema="{}"),
            step("load", "toMySQL", url="jdbc:mysql://m/x", table="out", mode="overwrite", batchSize=5000),
            step("load", "toKafka", topic="u", **{"bootstrap.servers": "c:2"}),
        ),
        credentials=secrets,
    )
    assert seen["read_jdbc"][1]["url"] == "jdbc:postgresql://db:5432/shop"
    assert seen["read_jdbc"][1]["query"] == "select 1" and seen["read_jdbc"][1]["partitions"] == 20
    assert seen["read_kafka"] == (("t", False), {"properties": secrets["kafka"], "endingOffsets": "latest"})
    assert seen["read_table"][0] == ("/d", 3, None, "delta")
    assert seen["read_avro"][0] == ("/a", "{}", None)
    assert seen["write_jdbc"][1]["batch_size"] == 5000 and seen["write_jdbc"][1]["mode"] == "overwrite"
    assert seen["write_kafka"] == (("u",), {"properties": {"bootstrap.servers": "c:2"}})
    assert run.current().count() == 3
    with pytest.raises(ValueError, match="needs a url"):
        run_steps(spark, spec(step("extract", "fromPostgres", table="t", credentialPath="missing")))


def test_messages_that_do_not_parse_are_registered(spark, tmp_path):
    messages = spark.createDataFrame([('{"id": 1}', "a"), ("oops", "b"), (None, "c")], "value string, topic string")
    load = step("load", "toDeltaLake", path=str(tmp_path / "bad"), tableFormat="parquet", inputDataFrame="bad")
    run = run_steps(spark, spec(step("transform", "decodeMessages", schema="id int", keepColumns=["topic"], rejectsAs="bad"), load), primary=messages)
    assert rows(run.current()) == [("a", 1)]
    assert rows(spark.read.parquet(str(tmp_path / "bad"))) == [("b", "oops"), ("c", None)]


def test_kafka_steps_keep_what_does_not_parse(spark, monkeypatch):
    from weir import sources

    messages = spark.createDataFrame([('{"id": 1}',), ("oops",)], "value string")
    monkeypatch.setattr(sources, "read_kafka", lambda *args, **kwargs: messages)
    run = run_steps(spark, spec(step("extract", "fromKafka", topic="t", schema="id int")))
    assert rows(run.current()) == [(1,)] and rows(run.frame("t_rejects")) == [("oops",)]


def test_incremental_extracts_start_from_a_checkpoint(spark, tmp_path, monkeypatch):
    from weir import sources

    spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, t int").write.parquet(str(tmp_path / "t"))
    since = {"checkpoint": "marks", "column": "t", "checkpointColumn": "done"}

    def extract(marks, **more):
        frames = {"marks": spark.createDataFrame(marks, "done int")}
        table = step("extract", "fromDeltaLake", path=str(tmp_path / "t"), tableFormat="parquet", incremental={**since, **more})
        return rows(run_steps(spark, spec(table), frames).current())

    assert extract([(20,), (5,)]) == [(3, 30)]
    assert extract([]) == [] and extract([], initial=10) == [(2, 20), (3, 30)]
    seen = {}
    monkeypatch.setattr(sources, "read_jdbc", lambda spark, **given: seen.update(given) or spark.range(1))

    def query(marks, **config):
        frames = {"marks": spark.createDataFrame(marks, "done timestamp")}
        source = step("extract", "fromPostgres", url="jdbc:x", partitionColumn="id", **config)
        run_steps(spark, spec(source), frames)
        return seen["query"]

    from datetime import datetime

    assert query([(datetime(2024, 5, 1, 7),)], table="orders", incremental=since) == "select * from orders where t > '2024-05-01 07:00:00'"
    assert query([], query="select 1 as t", incremental={**since, "initial": 0}) == "select * from (select 1 as t) t where t > '0'"
    assert seen["lower_bound"] is None  # the reader asks for it
    with pytest.raises(ValueError, match="checkpoint is empty"):
        query([], table="orders", incremental=since)


def test_history_is_kept_on_success_and_failure(spark, wells, tmp_path):
    from weir.metrics import read_history, throughput

    folder = str(tmp_path / "history")
    load = step("load", "toS3", **s3(str(tmp_path / "out")))
    run_steps(spark, spec(load), primary=wells, history=folder)
    with pytest.raises(ValidationFailed):
        run_steps(
            spark, spec(step("validate", "validateRanges", ranges={"depth": [20, 99]}), load), primary=wells, history=folder
        )
    lines = read_history(spark, folder)
    assert rows(lines.select("method", "status", "records")) == [
        ("toS3", "SUCCESS", 3), ("validateRanges", "FAILED", None),
    ]
    assert throughput(lines).first().records == 3


def test_rows_of_every_step_are_counted(spark, pumps, tmp_path):
    out = {"path": str(tmp_path / "out"), "tableFormat": "parquet"}
    names = spark.createDataFrame([("on", "running")], "state string, label string")
    steps = [
        step("extract", "fromS3", **s3(pumps, registerAs="pumps")),
        step("extract", "fromS3", **s3(pumps, registerAs="unused")),
        step("transform", "joinDataFrames", inputDataFrames=["pumps", "names"], joinColumn="state"),
        step("validate", "validateRanges", ranges={"flow": {"min": 100}}, onViolation="quarantine", rejectsAs="bad"),
        step("transform", "filterRows", condition="flow < 300"),
        step("validate", "validateNulls", notNullColumns=["site"]),
        step("load", "toDeltaLake", **out),
    ]
    run = run_steps(spark, spec(*steps), {"names": names}, count_rows=True)
    assert [line["records"] for line in run.metrics] == [5, None, 3, 3, 1, 1, 1]
    plain = run_steps(spark, spec(*steps), {"names": names})
    assert [line["records"] for line in plain.metrics] == [None] * 6 + [1]


def test_a_failed_validation_tells_how_many_rows_it_saw(spark, pumps, tmp_path):
    path = str(tmp_path / "history")
    failing = step("validate", "validateRanges", ranges={"flow": {"min": 100}})
    with pytest.raises(ValidationFailed):
        run_steps(spark, spec(failing), primary=spark.read.parquet(pumps), history=path, count_rows=True)
    assert [(r.status, r.records) for r in spark.read.json(path).collect()] == [("FAILED", 5)]
