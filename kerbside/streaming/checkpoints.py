"""What a stream has committed, read from its checkpoint.

A checkpoint holds a file a batch in ``offsets`` (what the batch was to read: a version line, a line of metadata, one
line a source) and, once the batch was done, in ``commits``. A file source keeps in ``sources/<n>`` which files a
batch took. All of them are read as tables: nothing is listed or parsed on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "^[0-9]+(\\.compact)?$"


def _files(spark: SparkSession, path: str, *, lines: bool) -> DataFrame:
    """Log files of a folder: name and whole text, or name and line."""
    rows = spark.read.text(path, wholetext=not lines).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "value")
    return rows.where(F.col("name").rlike(_LOG))


def planned(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch, source (number) and its end offset, as text, of every batch that was planned."""
    rows = _files(spark, f"{checkpoint}/offsets", lines=False)
    line = F.posexplode(F.split("value", "\n")).alias("line", "offset")
    return (rows.select(F.col("name").cast("long").alias("batch"), line).where("line >= 2 and offset <> '-'")
            .select("batch", (F.col("line") - 2).alias("source"), "offset"))


def committed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """batch of every batch that was done."""
    return _files(spark, f"{checkpoint}/commits", lines=False).select(F.col("name").cast("long").alias("batch"))


def committed_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Q3: batch, source, topic, partition and end offset of all committed batches. A log source tells an offset for each
    topic and partition; a file source only how many of its log's entries it has read (topic and partition are null)."""
    rows = planned(spark, checkpoint).join(committed(spark, checkpoint), "batch", "left_semi")
    parts = F.from_json("offset", "map<string,string>")
    rows = rows.select("batch", "source", F.explode(parts).alias("topic", "value"))
    files = rows.where("topic = 'logOffset'").select("batch", "source", F.lit(None).cast("string").alias("topic"),
                                                     F.lit(None).cast("int").alias("partition"), F.col("value").cast("long").alias("end_offset"))
    topics = (rows.where("topic <> 'logOffset'")
              .select("batch", "source", "topic", F.explode(F.from_json("value", "map<string,bigint>")).alias("partition", "end_offset"))
              .withColumn("partition", F.col("partition").cast("int")))
    return files.unionByName(topics)


def last_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Q3: per source, topic and partition the last committed end offset and the number of committed batches."""
    return committed_offsets(spark, checkpoint).groupBy("source", "topic", "partition").agg(
        F.max("end_offset").alias("end_offset"), F.count_distinct("batch").alias("batches"))


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """path and batch of the files that a file source has read in committed batches (null for batches whose logs Spark has
    cleared away since)."""
    rows = _files(spark, f"{checkpoint}/sources/{source}", lines=True).where("value like '{%'")
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    # a compacted log repeats the entries of the logs before it
    read = rows.select(entry.alias("e")).select("e.path", F.col("e.batchId").alias("log")).distinct()
    done = (planned(spark, checkpoint).join(committed(spark, checkpoint), "batch", "left_semi").where(F.col("source") == source)
            .groupBy(F.get_json_object("offset", "$.logOffset").cast("long").alias("upto")).agg(F.min("batch").alias("batch")))
    last = done.agg(F.max("upto")).scalar()
    return read.where(F.col("log") <= last).join(done, F.col("log") == F.col("upto"), "left").select("path", "batch")


def file_key(path: str | Column) -> Column:
    """A file's path without its scheme and escapes, so that paths from logs and from scans compare."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^[a-z0-9]+:/+", "/")


def reconcile(landed: DataFrame, raw: DataFrame, files: DataFrame) -> DataFrame:
    """Q2 + Q3 + Q4 by rows: per topic what was landed, what lies in files that committed batches have read, what of that the
    raw table lacks (loss), and what still waits (lag). ``landed`` needs topic, partition, offset and ``file``, ``raw`` the
    coordinates, ``files`` the paths of ``committed_files``."""
    keys = ["topic", "partition", "offset"]
    read = files.select(file_key("path").alias("__file"), F.lit(True).alias("__read")).distinct()
    there = raw.select(*keys).distinct().withColumn("__there", F.lit(True))
    x = landed.withColumn("__file", file_key("file")).join(read, "__file", "left").join(there, keys, "left")
    was, has = F.coalesce("__read", F.lit(False)), F.coalesce("__there", F.lit(False))
    return x.groupBy("topic").agg(
        F.count(F.lit(1)).alias("landed"), F.count(F.when(was, 1)).alias("committed"), F.count(F.when(was & ~has, 1)).alias("lost"),
        F.count(F.when(~was, 1)).alias("lag"))
