from weir.streaming.events import (
    deduplicate_within,
    dropped_rows,
    end_folder,
    interval_join,
    mark_end,
    session_aggregate,
    watermarked,
    window_aggregate,
    with_end,
    write_split_late,
)
from weir.streaming.streams import (
    any_active,
    await_all,
    read_file_stream,
    stop_all,
    write_kafka_stream,
    write_stream,
)
from weir.streaming.triggers import parse_trigger

__all__ = [
    "any_active",
    "await_all",
    "deduplicate_within",
    "dropped_rows",
    "end_folder",
    "interval_join",
    "mark_end",
    "parse_trigger",
    "read_file_stream",
    "session_aggregate",
    "stop_all",
    "watermarked",
    "window_aggregate",
    "with_end",
    "write_kafka_stream",
    "write_split_late",
    "write_stream",
]
