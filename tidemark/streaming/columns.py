"""The columns a stream has met so far, kept beside its positions."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.json_text import merge_types
from tidemark.session import last_batch


def columns_so_far(spark: SparkSession, checkpoint: str, batch_id: int, found: T.StructType) -> T.StructType:
    """The columns of a micro-batch and of all before it, so that later batches keep what earlier ones had.

    They are written under the checkpoint whenever a batch adds some, so a restart knows them. A replayed batch takes only
    those of batches before it and writes what it wrote at first. Files of earlier batches keep their columns as they are:
    one whose type a later batch widens must be read as the type it had.
    """
    path = f"{checkpoint}/message-columns"
    before = last_batch(spark, path, batch_id)
    known = None
    if before >= 0:
        known = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{before}").first()["value"]))
    merged = merge_types(known, found) if known else found
    if merged != known:
        text = spark.createDataFrame([(merged.json(),)], "value STRING").coalesce(1)
        text.write.mode("overwrite").text(f"{path}/{batch_id}")
    return merged
