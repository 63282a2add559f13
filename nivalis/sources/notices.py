"""Object-created notifications: batch JSON files, JSON text columns, or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([
    T.StructField("eventVersion", T.StringType()),
    T.StructField("eventSource", T.StringType()),
    T.StructField("awsRegion", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("eventName", T.StringType()),
    T.StructField("s3", T.StructType([
        T.StructField("s3SchemaVersion", T.StringType()),
        T.StructField("configurationId", T.StringType()),
        T.StructField("bucket", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("arn", T.StringType()),
        ])),
        T.StructField("object", T.StructType([
            T.StructField("key", T.StringType()),
            T.StructField("size", T.LongType()),
            T.StructField("eTag", T.StringType()),
            T.StructField("sequencer", T.StringType()),
        ])),
    ])),
])
NOTICE = T.StructType([T.StructField("Records", T.ArrayType(RECORD))])


def _records(df: DataFrame, keep) -> DataFrame:
    x = df.select(*keep, F.posexplode("Records").alias("record_no", "rec"))
    return x.select(
        *keep, "record_no",
        F.col("rec.eventTime").alias("event_time"),
        F.col("rec.s3.bucket.name").alias("bucket"),
        F.url_decode(F.col("rec.s3.object.key")).alias("key"),
        F.col("rec.s3.object.sequencer").alias("sequencer"),
    )


def read_notices(spark: SparkSession, path: str, pretty: bool = True) -> DataFrame:
    """Notification files -> one row per record (every record, not just the first).

    ``pretty`` files hold one document over many lines; the others one
    document per line, and can be split.  A document that is no notification
    gives no row.
    """
    df = spark.read.schema(NOTICE).option("multiLine", str(pretty).lower()).json(path)
    return _records(df.withColumn("source_file", F.input_file_name()), ["source_file"])


def notices_from_json(df: DataFrame, col: str, keep=()) -> DataFrame:
    """Notification documents held as JSON text in a column."""
    parsed = df.select(*keep, F.from_json(F.col(col), NOTICE).alias("n"))
    return _records(parsed.select(*keep, "n.Records"), list(keep))
