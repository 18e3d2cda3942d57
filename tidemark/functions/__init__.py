from tidemark.functions.aggregates import expand_my_average, my_average, my_average_sql, text_list
from tidemark.functions.dates import (
    LOG_DATE_PATTERN,
    LOG_STREAM_DATE_PATTERN,
    UPDATE_DATE_PATTERN,
    add_date_part,
    date_part,
    date_part_with,
)
from tidemark.functions.json_text import (
    infer_json_schema,
    json_field,
    json_value,
    merge_types,
    parse_declared,
    parse_inferred,
)

__all__ = [
    "LOG_DATE_PATTERN",
    "LOG_STREAM_DATE_PATTERN",
    "UPDATE_DATE_PATTERN",
    "add_date_part",
    "date_part",
    "date_part_with",
    "expand_my_average",
    "infer_json_schema",
    "json_field",
    "json_value",
    "merge_types",
    "my_average",
    "my_average_sql",
    "parse_declared",
    "parse_inferred",
    "text_list",
]
