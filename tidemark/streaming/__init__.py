from tidemark.streaming.offsets import offset_ranges, partition_report
from tidemark.streaming.run import console, each_batch, pass_through, run, write_stream

__all__ = ["console", "each_batch", "offset_ranges", "partition_report", "pass_through", "run", "write_stream"]
