"""Schemas of the inputs."""

from pyspark.sql import types as T

# Field names and types of a profile-update message.
PROFILE_UPDATE = T.StructType(
    [
        T.StructField("user_fname", T.StringType()),
        T.StructField("user_lname", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("modified_fields", T.ArrayType(T.StringType())),
    ]
)

# Columns of an application log line. The date stays text, so that its pattern is
# checked by the date-part expression and nowhere else.
APP_LOG = T.StructType(
    [
        T.StructField("application", T.StringType()),
        T.StructField("module", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("response_time", T.LongType()),
    ]
)

# One record of a topic, whatever holds the topic.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
