"""Similarity search over stored unit vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelens.functions.vectors import dot, unit


def build_index(rows: DataFrame, vector: str, path: str | None = None) -> DataFrame:
    """Rows with unit vectors; written as Parquet if there is a path."""
    index = rows.withColumn(vector, unit(F.col(vector)))
    if path is None:
        return index
    index.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def search(index: DataFrame, query: list[float], vector: str = "embedding", key: str = "vec_id", k: int = 30, least: float = 0.1) -> DataFrame:
    """The k nearest by cosine and, of these, those with a score of at least ``least``. Reads the index once."""
    target = F.array(*[F.lit(float(v)) for v in query])
    scored = index.withColumn("score", dot(F.col(vector), unit(target)))
    return scored.orderBy(F.desc("score"), key).limit(k).where(F.col("score") >= least).select(key, "score")


#: Index vectors of a lane, and of them those that are multiplied at once.
LANE, SLAB = 1 << 17, 4096


class _Lane:
    """The index vectors of a lane by their length; answers queries one by one."""

    def __init__(self, k: int, least: float) -> None:
        self.k, self.least = k, least
        self.names: dict[int, list] = {}
        self.vectors: dict[int, list | np.ndarray] = {}

    def add(self, name, vector: list[float]) -> None:
        self.names.setdefault(len(vector), []).append(name)
        self.vectors.setdefault(len(vector), []).append(np.array(vector))

    def best(self, vector: list[float]) -> list[tuple]:
        """(key, score) of the k best of at least the least score, ties to the smaller key."""
        n, q, found = len(vector), np.array(vector), []
        if n not in self.names:
            return []
        if isinstance(self.vectors[n], list):
            self.vectors[n] = np.array(self.vectors[n])
        for at in range(0, len(self.names[n]), SLAB):
            # A sum for each row alone, so that equal vectors have equal scores wherever they stand.
            scores = (self.vectors[n][at : at + SLAB] * q).sum(axis=1)
            high = max(self.least, np.partition(scores, -self.k)[-self.k]) if len(scores) > self.k else self.least
            found += [(-scores[i], self.names[n][at + i]) for i in np.flatnonzero(scores >= high).tolist()]
            found = sorted(found)[: self.k]
        return [(name, -score) for score, name in found]


def search_many(index: DataFrame, queries: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = 30, least: float = 0.1) -> DataFrame:
    """The same for any number of queries (query, embedding), each against the whole index: (query, key, score).

    Index rows are dealt into lanes of about ``LANE`` rows and every query goes to each lane. A task holds one lane and
    the queries stream past it; of each meeting the k best are kept, and these few are ranked in the end. A vector that
    is null or has another length than a query scores nothing there.
    """
    spark = index.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(n, -(-index.count() // LANE))
    double = lambda c: F.transform(F.col(c), lambda x: x.cast("double"))
    stored = index.where(F.col(vector).isNotNull()).select(F.pmod(F.xxhash64(key, vector), F.lit(lanes)).cast("int").alias("lane"), F.lit(0).alias("asks"), F.col(key).alias("key"), double(vector).alias("v"))
    asked = queries.where(F.col(vector).isNotNull()).select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(1).alias("asks"), F.col("query"), unit(F.col(vector)).alias("v"))
    rows = stored.unionByName(asked, allowMissingColumns=True).select("lane", "asks", "key", "query", "v")
    types = rows.schema

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, lane = None, _Lane(k, least)
        for batch in batches:
            out: list[tuple] = []
            for number, asks, name, query, v in zip(*(c.to_pylist() for c in batch.columns)):
                if number != here:
                    here, lane = number, _Lane(k, least)
                if asks:
                    out += [(query, *found) for found in lane.best(v)]
                else:
                    lane.add(name, v)
            kinds = (batch.schema.field("query").type, batch.schema.field("key").type, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["query", key, "score"])

    # The rows of a lane come before the queries.
    dealt = rows.repartition(n, "lane").sortWithinPartitions("lane", "asks")
    few = dealt.mapInArrow(answer, f"query {types['query'].dataType.simpleString()}, `{key}` {types['key'].dataType.simpleString()}, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), key)
    return few.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def top_classes(scores: Column, k: int = 5) -> Column:
    """The k class numbers of highest score, ties to the smaller number."""
    ranked = F.array_sort(F.transform(scores, lambda v, i: F.struct((-v).alias("s"), i.alias("c"))))
    return F.slice(F.transform(ranked, lambda s: s["c"]), 1, k)
