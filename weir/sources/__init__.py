from weir.sources.files import object_uri, read_avro, read_files, read_table
from weir.sources.jdbc import bounds_query, jdbc_read_options, jdbc_url, newer_rows_query, read_jdbc, split_bounds
from weir.sources.kafka import decode_json, kafka_options, kafka_read_options, read_kafka, split_json
from weir.sources.synthetic import synthetic_rows

__all__ = [
    "bounds_query",
    "decode_json",
    "jdbc_read_options",
    "jdbc_url",
    "kafka_options",
    "kafka_read_options",
    "newer_rows_query",
    "object_uri",
    "read_avro",
    "read_files",
    "read_jdbc",
    "read_kafka",
    "read_table",
    "split_bounds",
    "split_json",
    "synthetic_rows",
]
