"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that hold whole texts; keeps a Python worker's memory bounded.
BATCH_ROWS = 512


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; set here only where it is unset and
    the session is local."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        if own.isDefined():
            return own.get().rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="kerbside-llm-")
        spark.sparkContext.setCheckpointDir(where)
        return shared_dir(spark)
    return where.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: its lineage is cut, and losing
    an executor loses none of it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, unless the user has chosen a size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """At the end of a task that held much: a Python worker lives on for later tasks, so what it has freed
    goes back to the system."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library keeps it for itself


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut_key(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string"))


def local_path(uri: str) -> str:
    """URI for pyarrow.fs: plain paths become file URIs."""
    return uri if "://" in uri else "file://" + os.path.abspath(uri.removeprefix("file:"))


def by_group(rows: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work`` on the rows of each key, given as arrays by column; it returns lists by output column, or
    None. Groups must be bounded: one is held at a time. Cheaper than a grouped map for many small groups."""
    names = rows.columns
    fields = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(frames):
        import numpy as np
        import pandas as pd

        held = None
        out: dict[str, list] = {f: [] for f in fields}
        size = 0

        def do(cols: dict, bounds) -> None:
            nonlocal size
            for a, b in zip(bounds[:-1], bounds[1:]):
                got = work({c: v[a:b] for c, v in cols.items()})
                if got is not None:
                    for f, values in zip(fields, got):
                        out[f].extend(values)
                    size += len(got[0])

        for frame in frames:
            if not len(frame):
                continue
            if held is not None:
                frame = pd.concat([held, frame], ignore_index=True)
            cols = {c: frame[c].to_numpy() for c in names}
            change = np.zeros(len(frame) - 1, bool)
            for k in keys:
                change |= cols[k][1:] != cols[k][:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1])
            do(cols, starts)
            held = frame.iloc[starts[-1]:]
            if size >= 2000:
                yield pd.DataFrame(out)
                out, size = {f: [] for f in fields}, 0
        if held is not None:
            do({c: held[c].to_numpy() for c in names}, [0, len(held)])
        if size:
            yield pd.DataFrame(out)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def shield(docs: DataFrame, *needed: str):
    """``docs`` with every column but the needed ones under a name that no operator uses, and a function that
    gives a result its columns back under their own names and in their order. Needed columns that are missing
    come as null strings and go again."""
    own = {c.lower(): c for c in docs.columns}
    inner = {c: next((n for n in needed if n == c.lower()), f"_x{i}") for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(inner[c]) for c in docs.columns],
                        *[F.lit(None).cast("string").alias(n) for n in needed if n not in own])

    def back(result: DataFrame) -> DataFrame:
        return result.select(*[F.col(inner[c]).alias(c) for c in docs.columns])

    return plain, back
