import pytest
from conftest import rows
from weir.operators import enrich, filter_rows, join_using, quarantine, range_checks
from weir.sinks import kafka_frame
from weir.sources import decode_json
from weir.streaming import (
    any_active,
    await_all,
    parse_trigger,
    read_file_stream,
    stop_all,
    write_stream,
)


@pytest.mark.parametrize(
    "text, want",
    [
        ("once", {"availableNow": True}),
        ("availableNow", {"availableNow": True}),
        ("5 seconds", {"processingTime": "5 seconds"}),
        ("1 minute", {"processingTime": "1 minute"}),
        ("2 Hours", {"processingTime": "2 hours"}),
        ("processingTime=10 seconds", {"processingTime": "10 seconds"}),
    ],
)
def test_triggers(text, want):
    assert parse_trigger(text) == want


def test_unknown_trigger():
    with pytest.raises(ValueError):
        parse_trigger("whenever")


SCHEMA = "id long, kind string, v double"


@pytest.fixture
def queue(spark, tmp_path):
    folder = str(tmp_path / "queue")
    df = spark.range(0, 200, 1, 5).selectExpr("id", "if(id % 4 = 0, 'buy', 'view') as kind", "id * 1.5D as v")
    df.write.parquet(folder)
    return folder, df


def test_stream_equals_batch(spark, tmp_path, queue):
    folder, batch = queue

    def steps(df):
        messages = kafka_frame(enrich(filter_rows(df, "kind = 'buy'"), {"high": "v >= 100"}))
        return decode_json(messages, SCHEMA + ", high boolean")

    stream = read_file_stream(spark, folder, SCHEMA, max_files_per_trigger=2)
    out = steps(stream)
    query = write_stream(
        out, str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), trigger="once", query_name="buys"
    )
    assert query.name == "buys"
    assert await_all([query], timeout=120)
    assert not any_active([query])
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert rows(spark.read.schema(out.schema).parquet(str(tmp_path / "out"))) == rows(steps(batch))


def test_restart_resumes_from_the_checkpoint(spark, tmp_path, queue):
    folder, batch = queue
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):
        stream = read_file_stream(spark, folder, SCHEMA)
        await_all([write_stream(stream, target, checkpoint=checkpoint, trigger="once")])
    assert spark.read.parquet(target).count() == 200
    batch.selectExpr("id + 1000 as id", "kind", "v").write.mode("append").parquet(folder)
    await_all([write_stream(read_file_stream(spark, folder, SCHEMA), target, checkpoint=checkpoint, trigger="once")])
    assert spark.read.parquet(target).count() == 400


def test_quarantine_and_static_join_on_a_stream(spark, tmp_path, queue):
    folder, batch = queue
    names = spark.createDataFrame([("buy", "B"), ("view", "V")], "kind string, label string")
    stream = read_file_stream(spark, folder, SCHEMA)
    clean, failed = quarantine(join_using([stream, names], "kind"), range_checks({"v": [10, 250]}))
    for part, name in ((clean, "clean"), (failed, "failed")):
        await_all([write_stream(part, str(tmp_path / name), trigger="once", partition_by=["kind"])])
    kept = spark.read.parquet(str(tmp_path / "clean"))
    lost = spark.read.parquet(str(tmp_path / "failed"))
    assert kept.count() + lost.count() == 200
    assert kept.filter("v < 10 or v > 250").count() == 0
    assert set(kept.columns) == {"id", "kind", "v", "label"}


def test_running_queries_stop(spark, tmp_path, queue):
    folder, _ = queue
    stream = read_file_stream(spark, folder, SCHEMA)
    query = write_stream(stream, str(tmp_path / "out"), trigger="1 hour")
    assert any_active([query])
    assert not await_all([query], timeout=0.2)
    stop_all([query])
    assert not any_active([query])


def test_batch_frames_are_refused(spark):
    with pytest.raises(ValueError, match="batch frame"):
        write_stream(spark.range(1), "/nowhere")
