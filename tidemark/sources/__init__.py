from tidemark.sources.logs import infer_log_schema, parse_log_lines, read_logs, stream_lines
from tidemark.sources.topics import KafkaTopics, RecordFiles, as_records, open_topics

__all__ = [
    "KafkaTopics",
    "RecordFiles",
    "as_records",
    "infer_log_schema",
    "open_topics",
    "parse_log_lines",
    "read_logs",
    "stream_lines",
]
