"""Run a list of step specifications over a primary frame and named frames.

A specification is what a JSON pipeline file holds: ``name``, ``mode`` and
``steps``, each with ``type``, ``method`` and ``config``. Extract and transform
steps only build plans. Validate steps next to each other share one scan, and
load steps write.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weir import metrics, operators, sinks, sources, streaming
from weir.functions.guards import check_sql_text
from weir.operators import quality
from weir.session import sized_shuffles

# Step types, and method names with what they stand for.
STEP_TYPES = ("extract", "transform", "validate", "load")
MODES = ("batch", "streaming")
JDBC_DATABASE = {
    "fromPostgres": "postgres",
    "fromMySQL": "mysql",
    "toPostgres": "postgres",
    "toMySQL": "mysql",
}
FILE_SINKS = ("toS3", "toDeltaLake", "toAvro")
ACTIONS = ("fail", "filter", "quarantine")
MOST_BYTES = 1 << 60
ROW_CHECKS = ("validateNulls", "validateRanges", "validateBusinessRules")


@dataclass
class Run:
    """State threaded through the steps, and the result of a run."""

    spark: SparkSession
    name: str = "pipeline"
    streaming: bool = False
    credentials: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    primary: DataFrame | None = None
    frames: dict[str, DataFrame] = field(default_factory=dict)
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    cached: list[DataFrame] = field(default_factory=list)
    metrics: list[dict[str, Any]] = field(default_factory=list)
    count_rows: bool = False
    observations: dict[int, Observation] = field(default_factory=dict)
    # steps whose rows are counted by the time a frame has been computed, by the frame's id
    counted: dict[int, frozenset[int]] = field(default_factory=dict)
    done: set[int] = field(default_factory=set)
    kept: list[DataFrame] = field(default_factory=list)

    def counting(self, df: DataFrame, step: int, *sources: DataFrame) -> DataFrame:
        """``df`` with its rows counted as they are computed, where the run asks for it."""
        if not self.count_rows or df.isStreaming:
            return df
        df, self.observations[step] = metrics.observe(df, f"{self.name}-{step}-{uuid.uuid4().hex[:8]}")
        before = [self.counted.get(id(source), frozenset()) for source in sources]
        self.counted[id(df)] = frozenset({step}).union(*before)
        self.kept.append(df)  # so that its id stays its own
        return df

    def computed(self, df: DataFrame) -> None:
        self.done |= self.counted.get(id(df), frozenset())

    def current(self) -> DataFrame:
        if self.primary is None:
            raise ValueError("no frame yet: start with an extract step or a named frame")
        return self.primary

    def release(self) -> None:
        """Give back what cache steps keep in memory; the frames themselves stay usable."""
        for df in self.cached:
            operators.uncache(df)
        self.cached.clear()

    def frame(self, name: str) -> DataFrame:
        if name not in self.frames:
            raise KeyError(f"no frame named {name!r}; there are {sorted(self.frames)}")
        return self.frames[name]


def run_steps(
    spark: SparkSession,
    spec: Mapping[str, Any],
    frames: Mapping[str, DataFrame] | None = None,
    primary: DataFrame | None = None,
    credentials: Mapping[str, Mapping[str, Any]] | None = None,
    history: str | None = None,
    release: bool = False,
    count_rows: bool = False,
) -> Run:
    """Fold the steps; returns the last primary frame, named frames and queries.

    ``frames`` and ``primary`` can be given beforehand, as library use does.
    ``credentials`` maps each ``credentialPath`` in the steps to its options.
    ``history`` names a folder that the step metrics are appended to, whether
    the run succeeds or fails. ``release`` uncaches at the end of the run.
    ``count_rows`` records the rows of every batch step: those that an extract or
    transform step gives, and those that a validation sees. They are counted as
    later steps compute them, without a scan of their own; a step that nothing
    computed has none. Filters are not pushed below a counted step.

    Shuffles are sized by the input of each step that computes something, and
    the session's setting is as before afterwards.
    """
    mode = spec.get("mode", "batch")
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}: {mode!r}")
    steps = [dict(step, index=i, config=dict(step.get("config", {}))) for i, step in enumerate(spec["steps"])]
    if not steps:
        raise ValueError("give at least one step")
    for step in steps:
        if step["type"] not in STEP_TYPES:
            raise ValueError(f"step type is one of {STEP_TYPES}: {step['type']!r}")
    run = Run(
        spark,
        spec.get("name", "pipeline"),
        mode == "streaming",
        credentials or {},
        primary,
        dict(frames or {}),
        count_rows=count_rows,
    )
    try:
        for shared, group in groupby(steps, key=_scan_key):
            members = list(group)
            for batch in [members] if shared[0] == "checks" else [[step] for step in members]:
                _timed_step(run, batch)
    finally:
        for line in run.metrics:
            if line["step"] in run.done and line["records"] is None:
                line["records"] = metrics.observed(run.observations[line["step"]]).get("records")
        if release:
            run.release()
        if history and run.metrics:
            metrics.append_history(metrics.metrics_frame(spark, run.metrics), history)
    return run


def _scan_key(step: Mapping[str, Any]) -> tuple[str, str]:
    if step["type"] == "validate" and step["method"] in ROW_CHECKS:
        config = step["config"]
        return "checks", f"{config.get('onViolation', 'fail')} {config.get('rejectsAs', '')}"
    return "single", ""


def _timed_step(run: Run, steps: list[dict[str, Any]]) -> None:
    kind = steps[0]["type"]
    act = {"extract": _extract, "transform": _transform, "validate": _validate, "load": _load}[kind]


    def sized() -> Any:
        frame = run.primary
        if kind not in ("validate", "load") or frame is None or frame.isStreaming:
            return act(run, steps)
        with sized_shuffles(run.spark, _input_bytes(frame)):
            return act(run, steps)

    status, millis, result = metrics.timed(sized)
    for step in steps:
        run.metrics.append(
            {
                "pipeline": run.name,
                "step": step["index"],
                "type": kind,
                "method": step["method"],
                "status": status,
                # checks that share a scan share its time: the first has it
                "duration_ms": millis if step is steps[0] else 0,
                "records": result if kind == "load" and status == "SUCCESS" else None,
            }
        )
    if status == "FAILED":
        raise result


def _input_bytes(df: DataFrame) -> int:
    """Planned size; a frame without an estimate asks for no more partitions."""
    size = operators.planned_bytes(df)
    return 0 if size >= MOST_BYTES else size


def _store(run: Run, df: DataFrame, step: Mapping[str, Any], *sources: DataFrame) -> None:
    config = step["config"]
    df = run.counting(df, step["index"], *sources)
    if str(config.get("cache", False)).lower() == "true":
        before, df = df, operators.cache(df, config.get("cacheStorageLevel", "MEMORY_AND_DISK"))
        run.counted[id(df)] = run.counted.get(id(before), frozenset())
        run.cached.append(df)
    if config.get("registerAs"):
        run.frames[config["registerAs"]] = df
    run.primary = df


def _secrets(run: Run, config: Mapping[str, Any]) -> dict[str, Any]:
    path = config.get("credentialPath")
    return dict(run.credentials.get(path, {})) if path else {}


def _jdbc(run: Run, method: str, config: Mapping[str, Any]) -> dict[str, Any]:
    secret = {**_secrets(run, config), **{k: config[k] for k in ("url", "user", "password") if k in config}}
    database = JDBC_DATABASE[method]
    if not (secret.get("url") or secret.get("host")):
        raise ValueError(f"{method} needs a url, or credentials with host and database")
    url = secret.get("url") or sources.jdbc_url(
        database, secret["host"], secret["database"], secret.get("port")
    )
    return {
        "url": url,
        "driver": sources.jdbc.DATABASES[database][0],
        "user": secret.get("username", secret.get("user")),
        "password": secret.get("password"),
        "properties": secret.get("properties"),
    }


def _kafka(run: Run, config: Mapping[str, Any]) -> dict[str, Any]:
    servers = {key: config[key] for key in ("bootstrap.servers",) if key in config}
    return {**servers, **_secrets(run, config)}


def _object_store(run: Run, config: Mapping[str, Any]) -> tuple[str, dict[str, Any]]:
    secret = _secrets(run, config)
    names = {
        "accessKeyId": "fs.s3a.access.key",
        "secretAccessKey": "fs.s3a.secret.key",
        "sessionToken": "fs.s3a.session.token",
    }
    options = {names[key]: value for key, value in secret.items() if key in names}
    if secret.get("region"):
        options["fs.s3a.endpoint"] = f"s3.{secret['region']}.amazonaws.com"
    uri = sources.object_uri(config["bucket"], config["path"], config.get("scheme", "s3a"))
    return uri, options


def _extract(run: Run, steps: list[dict[str, Any]]) -> None:
    method, config = steps[0]["method"], steps[0]["config"]
    if method in ("fromPostgres", "fromMySQL"):
        df = sources.read_jdbc(
            run.spark,
            partition_column=config.get("partitionColumn"),
            lower_bound=config.get("lowerBound"),
            upper_bound=config.get("upperBound"),
            **_newer_query(run, config),
            partitions=config.get("numPartitions", sources.jdbc.PARTITIONS),
            **_jdbc(run, method, config),
        )
    elif method == "fromKafka":
        offsets = {
            key: config.get(key)
            for key in (*sources.kafka.STREAM_OPTIONS, "endingOffsets")
            if key in config
        }
        df = sources.read_kafka(
            run.spark, config["topic"], run.streaming, properties=_kafka(run, config), **offsets
        )
        if config.get("schema"):
            df = _decoded(run, df, config, config["topic"])
    elif method == "fromS3":
        uri, options = _object_store(run, config)
        reading = ("header", "inferSchema", "delimiter", "multiLine")
        given = {key: config[key] for key in reading if key in config}
        df = sources.read_files(
            run.spark, uri, config.get("format", "parquet"), config.get("schema"), **options, **given
        )
    elif method == "fromDeltaLake":
        df = sources.read_table(
            run.spark,
            config["path"],
            config.get("version"),
            config.get("timestamp"),
            config.get("tableFormat", "delta"),
        )
    elif method == "fromAvro":
        df = sources.read_avro(run.spark, config["path"], config.get("avroSchema"), config.get("inferSchema"))
    else:
        raise ValueError(f"unknown extract method {method!r}")
    if "incremental" in config and method not in JDBC_DATABASE:
        df = operators.newer_than(df, **_mark(run, config["incremental"]))
    _store(run, df, steps[0])


def _decoded(run: Run, df: DataFrame, config: Mapping[str, Any], name: str) -> DataFrame:
    """Decoded messages; the others are registered as ``rejectsAs``, as they came."""
    keep = tuple(config.get("keepColumns", ()))
    decoded, rejects = sources.split_json(df, config["schema"], config.get("valueColumn", "value"), keep)
    run.frames[config.get("rejectsAs", f"{name}_rejects")] = rejects
    return decoded


def _mark(run: Run, incremental: Mapping[str, Any]) -> dict[str, Any]:
    """Where an incremental extract starts: past the highest value of a checkpoint frame."""
    return {
        "column": incremental["column"],
        "checkpoint": run.frame(incremental["checkpoint"]),
        "checkpoint_column": incremental.get("checkpointColumn", incremental["column"]),
        "initial": incremental.get("initial"),
    }


def _newer_query(run: Run, config: Mapping[str, Any]) -> dict[str, Any]:
    """Table or query of a JDBC extract, past the mark of its checkpoint if it has one.

    The mark goes into the query as a literal, so that the database applies it.
    """
    if "incremental" not in config:
        return {"table": config.get("table"), "query": config.get("query")}
    mark = _mark(run, config["incremental"])
    latest = mark["checkpoint"].selectExpr(f"cast(max(`{mark['checkpoint_column']}`) as string)").first()[0]
    if latest is None and mark["initial"] is None:
        raise ValueError("the checkpoint is empty: say with 'initial' where to start")
    source = f"({config['query']}) t" if config.get("query") else config["table"]
    return {"query": sources.newer_rows_query(source, mark["column"], str(mark["initial"]) if latest is None else latest)}


def _transform(run: Run, steps: list[dict[str, Any]]) -> None:
    method, config = steps[0]["method"], steps[0]["config"]
    if method == "joinDataFrames":
        df = _join(run, config)
    elif method == "unionDataFrames":
        listed = [run.frame(name) for name in config["inputDataFrames"]]
        first = [run.current()] if config.get("includePrimary", True) else []
        df = operators.union_frames(first + listed, config.get("distinct", False))
    elif method == "filterRows":
        df = operators.filter_rows(run.current(), check_sql_text(config["condition"], "condition"))
    elif method == "decodeMessages":
        df = _decoded(run, run.current(), config, "decodeMessages")
    elif method == "enrichData":
        df = operators.enrich(run.current(), config["columns"])
    elif method == "aggregateData":
        df = operators.aggregate(run.current(), config["groupBy"], config["aggregations"])
    elif method == "reshapeData":
        df = _reshape(run.current(), config)
    elif method == "toAvroSchema":
        naming = {key: config[key] for key in ("namespace", "name") if key in config}
        df = operators.to_avro_schema(run.current(), **naming)
    elif method == "evolveAvroSchema":
        names = {"cast": "cast", "targetOrder": "target_order", "useDefaults": "use_defaults"}
        options = {names[key]: str(config[key]).lower() == "true" for key in names if key in config}
        df = operators.evolve(run.current(), config["targetSchema"], **options)
    elif method == "repartition":
        df = operators.repartition(run.current(), config["numPartitions"])
    elif method == "repartitionByColumns":
        df = operators.repartition_by(run.current(), config["columns"], config.get("numPartitions"))
    elif method == "coalesce":
        df = operators.coalesce(run.current(), config["numPartitions"])
    else:
        raise ValueError(f"unknown transform method {method!r}")
    named = [run.frames[name] for name in config.get("inputDataFrames", ()) if name in run.frames]
    own = [] if method == "joinDataFrames" or run.primary is None else [run.primary]
    _store(run, df, steps[0], *named, *own)


def _join(run: Run, config: Mapping[str, Any]) -> DataFrame:
    names = config["inputDataFrames"]
    how = config.get("joinType", "inner")
    key = config.get("joinColumn", config.get("joinKey"))
    small = config.get("broadcast", False)
    if "joinConditions" in config:
        return operators.join_frames(
            [(name, run.frame(name)) for name in names],
            config["joinConditions"],
            how,
            key_policy=config.get("keyPolicy", "coalesce"),
            hot_keys=bool(config.get("hotKeys", False)),
            broadcast=names[1:] if small else (),
        )
    if key is None:
        raise ValueError("a join needs joinConditions, joinColumn or joinKey")
    return operators.join_using(
        [run.frame(name) for name in names],
        key,
        how,
        hot_keys=bool(config.get("hotKeys", False)),
        broadcast=bool(small),
    )


def _reshape(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    operation = config["operation"].lower()
    if operation == "pivot":
        return operators.pivot(
            df,
            config["groupByColumns"],
            config["pivotColumn"],
            config.get("aggregateColumn"),
            config.get("aggFunction", "sum"),
            config.get("pivotValues"),
            config.get("pivotRest"),
        )
    if operation == "unpivot":
        return operators.unpivot(
            df, config["valueCols"], config["variableColName"], config["valueColName"], config.get("idCols")
        )
    raise ValueError(f"reshape operation is pivot or unpivot: {operation!r}")


def _validate(run: Run, steps: list[dict[str, Any]]) -> None:
    method, config, df = steps[0]["method"], steps[0]["config"], run.current()
    action = config.get("onViolation", "fail")
    if action not in ACTIONS:
        raise ValueError(f"onViolation is one of {ACTIONS}: {action!r}")
    before, df = df, run.counting(df, steps[0]["index"], df)
    if df is not before:
        run.primary = df
        run.observations.update(dict.fromkeys([s["index"] for s in steps], run.observations[steps[0]["index"]]))
        run.counted[id(df)] |= {s["index"] for s in steps}
    if method in ROW_CHECKS:
        checks = [check for step in steps for check in _checks(step)]
        if action != "fail":
            _keep(run, steps[0], *operators.quarantine(df, checks))
        elif df.isStreaming:
            raise ValueError("a stream cannot be counted; set onViolation to 'filter' or 'quarantine'")
        else:
            run.computed(df)
            operators.violation_report(df, checks, fail_fast=True)
    elif method == "validateSchema":
        if action == "fail":
            operators.validate_schema(df, config["expectedColumns"], fail_fast=True)
        else:
            _keep(run, steps[0], *operators.split_by_schema(df, config["expectedColumns"]))
    elif method == "validateReferentialIntegrity":
        keys = config["foreignKey"], run.frame(config["referencedDataFrame"]), config["referencedColumn"]
        if action == "fail":
            operators.validate_references(df, *keys, fail_fast=True)
        else:
            _keep(run, steps[0], *operators.split_references(df, *keys))
    else:
        raise ValueError(f"unknown validation method {method!r}")


def _keep(run: Run, step: Mapping[str, Any], valid: DataFrame, rejected: DataFrame) -> None:
    """Go on with the valid rows; ``quarantine`` registers the others as ``rejectsAs``."""
    for part in (valid, rejected):
        run.counted[id(part)] = run.counted.get(id(run.current()), frozenset())
        run.kept.append(part)
    run.primary = valid
    if step["config"]["onViolation"] == "quarantine":
        run.frames[step["config"].get("rejectsAs", f"{step['method']}_rejects")] = rejected


def _checks(step: Mapping[str, Any]) -> list[quality.Check]:
    method, config = step["method"], step["config"]
    if method == "validateNulls":
        return operators.null_checks(config["notNullColumns"])
    if method == "validateRanges":
        return operators.range_checks(config["ranges"])
    return operators.rule_checks([check_sql_text(rule, "rule") for rule in config["rules"]])


def _load(run: Run, steps: list[dict[str, Any]]) -> int | None:
    method, config = steps[0]["method"], steps[0]["config"]
    df = run.frame(config["inputDataFrame"]) if "inputDataFrame" in config else run.current()
    if run.streaming and df.isStreaming:
        query = _start_stream(run, method, config, df)
        name = config.get("queryName") or f"{method}_{uuid.uuid4().hex[:8]}"
        run.queries[name] = query
        return None
    mode = config.get("mode", "append")
    if sinks.save_mode(mode) != "ignore":
        run.computed(df)
    # Only a write that surely runs reports its count: not one that "ignore" may skip.
    counted = sinks.save_mode(mode) != "ignore" and method in FILE_SINKS
    observation = None
    if counted:
        df, observation = metrics.observe(df, f"{run.name}-{steps[0]['index']}-{uuid.uuid4().hex[:8]}")
    partition_by = config.get("partitionBy")
    if method in ("toPostgres", "toMySQL"):
        extra = {"batch_size": config["batchSize"]} if "batchSize" in config else {}
        sinks.write_jdbc(df, table=config["table"], mode=mode, **extra, **_jdbc(run, method, config))
    elif method == "toKafka":
        sinks.write_kafka(df, config["topic"], properties=_kafka(run, config))
    elif method == "toS3":
        uri, options = _object_store(run, config)
        file_format = config.get("format", "parquet")
        sinks.write_files(
            df, uri, file_format, mode, partition_by, config.get("compression"), _balanced(config), **options
        )
    elif method == "toDeltaLake":
        sinks.write_table(
            df,
            config["path"],
            mode,
            partition_by,
            config.get("mergeSchema"),
            config.get("overwriteSchema"),
            config.get("tableFormat", "delta"),
        )
    elif method == "toAvro":
        sinks.write_avro(
            df, config["path"], mode, partition_by, config.get("compression"), config.get("avroSchema")
        )
    else:
        raise ValueError(f"unknown load method {method!r}")
    return metrics.observed(observation).get("records", 0) if observation else None


def _balanced(config: Mapping[str, Any]) -> bool:
    """Even files: on request, and unless refused for partitioned loads, whose files else multiply."""
    return str(config.get("balance", bool(config.get("partitionBy")))).lower() == "true"


def _start_stream(run: Run, method: str, config: Mapping[str, Any], df: DataFrame) -> StreamingQuery:
    common = {
        "checkpoint": config.get("checkpointLocation"),
        "output_mode": config.get("outputMode", "append"),
        "trigger": config.get("trigger", streaming.triggers.DEFAULT_TRIGGER),
        "query_name": config.get("queryName"),
    }
    if method == "toKafka":
        return streaming.write_kafka_stream(df, config["topic"], properties=_kafka(run, config), **common)
    if method == "toDeltaLake":
        table_format = config.get("tableFormat", "delta")
        merge = sinks.files.delta_write_options(config.get("mergeSchema")) if table_format == "delta" else {}
        return streaming.write_stream(
            df, config["path"], table_format, partition_by=config.get("partitionBy"), **common, **merge
        )
    if method == "toS3":
        uri, options = _object_store(run, config)
        return streaming.write_stream(
            df,
            uri,
            config.get("format", "parquet"),
            partition_by=config.get("partitionBy"),
            compression=config.get("compression"),
            **options,
            **common,
        )
    raise ValueError(f"{method} cannot write a stream; use toKafka, toDeltaLake or toS3")
