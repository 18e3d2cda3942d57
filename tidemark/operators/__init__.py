from tidemark.operators.keyed import LOG_AGG_CATALOG, USER_PROFILE_CATALOG, Catalog, KeyedTable, content_key, dense_key, merge_into, run_key
from tidemark.operators.sinks import (
    avro_available,
    add_partitions,
    create_external_table,
    fan_out,
    group_for,
    preview,
    write_avro,
    write_partitioned,
    write_registered,
    write_text,
)

__all__ = [
    "LOG_AGG_CATALOG",
    "USER_PROFILE_CATALOG",
    "Catalog",
    "KeyedTable",
    "add_partitions",
    "avro_available",
    "content_key",
    "dense_key",
    "merge_into",
    "create_external_table",
    "fan_out",
    "group_for",
    "preview",
    "run_key",
    "write_avro",
    "write_partitioned",
    "write_registered",
    "write_text",
]
