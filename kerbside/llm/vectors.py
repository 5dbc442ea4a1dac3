"""Vectors that take part in a search or comparison, shared by the two embedding operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part: an id; a vector that is not null, not all zero and free of null,
    NaN and infinite components, and of the length that most of these have (the smaller length on a tie).
    Rows that share an id count as one vector, the smallest in array order."""
    clean = (rows.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                         F.col(f"`{vector}`").cast("array<double>").alias("vec"))
             .where("id is not null and vec is not null and size(vec) > 0")
             .where("not exists(vec, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
             .where("exists(vec, x -> x <> 0)"))
    clean = clean.groupBy("id").agg(F.min("vec").alias("vec"))
    lengths = clean.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return clean.where(F.size("vec") == (lengths[0]["n"] if lengths else 0))


def bounded_sample(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the ``most`` rows with the smallest hash of their id."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    vecs = np.stack([np.asarray(v, float) for v in got["vec"]]) if len(got) else np.zeros((0, 0))
    return got["id"].to_numpy(), vecs


def matrix(vecs: np.ndarray) -> np.ndarray:
    """Rows of a group as a matrix of doubles."""
    return np.stack([np.asarray(v, float) for v in vecs])
