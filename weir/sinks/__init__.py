from weir.sinks.files import (
    save_mode,
    write_avro,
    write_files,
    write_parquet_with_avro_schema,
    write_table,
)
from weir.sinks.jdbc import jdbc_write_options, write_jdbc
from weir.sinks.kafka import kafka_frame, kafka_write_options, write_kafka

__all__ = [
    "jdbc_write_options",
    "kafka_frame",
    "kafka_write_options",
    "save_mode",
    "write_avro",
    "write_files",
    "write_jdbc",
    "write_kafka",
    "write_parquet_with_avro_schema",
    "write_table",
]
