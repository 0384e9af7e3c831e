from rowtide.sources.lake import (
    data_files,
    range_options,
    read_source_table,
    read_table,
    with_event_date,
    write_by_date,
)
from rowtide.sources.records import (
    RECORD_TYPE,
    in_topic_order,
    kept_topics,
    kafka_options,
    of_table,
    peek,
    read_replay,
    read_topics,
    topics,
    write_replay,
)
from rowtide.sources.schemas import decode_inferred, schema_versions, spec_of, widened

__all__ = [
    "RECORD_TYPE",
    "data_files",
    "decode_inferred",
    "in_topic_order",
    "kafka_options",
    "kept_topics",
    "of_table",
    "peek",
    "range_options",
    "read_replay",
    "read_source_table",
    "read_table",
    "read_topics",
    "schema_versions",
    "spec_of",
    "topics",
    "widened",
    "with_event_date",
    "write_by_date",
    "write_replay",
]
