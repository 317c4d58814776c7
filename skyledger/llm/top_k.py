"""Exact top-k search by inner product with MaxScore.

Vectors are turned into integers. Each dimension of a query with a non-zero component is a term; its postings are the
vectors whose component there has the same sign (a positive contribution), by contribution; the other signs only
lower a score. Within one shard of the vectors and for one query:

1. A threshold comes from exact scores of the first postings of the strongest terms.
2. Terms are ordered by their upper bound (the largest contribution in the shard). The weakest terms whose bounds sum
   to less than the threshold are non-essential: a vector without a posting in an essential term can't get in.
3. The essential postings are traversed for candidates; then term after term, from the strongest bound to the weakest,
   is added, and candidates whose score so far plus the bounds still to come falls below the threshold go.
4. If the threshold is not positive, every vector of the shard is a candidate.

Shards and blocks of queries have bounded sizes and meet in a grid: each vector goes to every block, each query to
every shard. The results of the shards, k per query, are merged. Ties go to smaller ids.

Vectors that are null or hold a null, NaN or infinite component take no part, nor do rows with a null id. Components
are floor(scale * x) as 64-bit integers, beyond their range at its ends; shorter vectors count as zero in the
dimensions they lack; empty vectors score 0. A query's own row is every row with its id. Rows that repeat an id are
candidates each; as queries they are one (the smallest vector). Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED_TERMS, SEED_POSTINGS = 4, 32


@dataclass(frozen=True)
class Search:
    k: int = 10
    scale: int = 1024
    shard_rows: int = 8192
    block_rows: int = 2048
    # Terms added between two looks at the threshold.
    step: int = 4


def as_integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.forall(vector, fine)


def matrix(lists: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as columns of a matrix: one row per dimension, zeros where a vector has ended."""
    lists = lists.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    n = np.diff(offsets)
    out = np.zeros((int(n.max()) if len(n) else 0, len(n)), np.int64)
    row = np.repeat(np.arange(len(n)), n)
    out[np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], n), row] = values[offsets[0] : offsets[-1]]
    return out


class Shard:
    """Postings of the vectors of one shard; ``by_value[d]`` has its rows by the value of dimension d."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[:, order])
        self.by_value = np.argsort(self.vectors, axis=1, kind="stable")
        self.low = self.vectors.min(axis=1) if len(ids) else np.zeros(len(vectors), np.int64)
        self.high = self.vectors.max(axis=1) if len(ids) else np.zeros(len(vectors), np.int64)

    def _head(self, term: int, weight: int, n: int) -> np.ndarray:
        return self.by_value[term, ::-1][:n] if weight > 0 else self.by_value[term, :n]

    def search(self, query_id: int, query: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best."""
        dims = min(len(query), len(self.vectors))
        weight = query[:dims]
        bound = np.maximum(np.maximum(weight * self.low[:dims], weight * self.high[:dims]), 0)
        terms = np.flatnonzero(weight)
        terms = terms[np.argsort(-bound[terms], kind="stable")]
        rest = np.append(np.cumsum(bound[terms][::-1])[::-1], 0)  # bounds of the terms from each on
        own = self.ids == query_id
        threshold = self._threshold(weight, terms, own, k)
        essential = int(np.searchsorted(-rest, -threshold, side="right")) if threshold is not None and threshold > 0 else 0
        if threshold is not None and threshold > 0:
            near = np.zeros(len(self.ids), bool)
            for t in terms[:essential]:
                near |= self.vectors[t] * np.sign(weight[t]) > 0
            rows = np.flatnonzero(near & ~own)
        else:
            rows = np.flatnonzero(~own)
        score = np.zeros(len(rows), np.int64)
        for a in range(0, len(terms), step):
            group = terms[a : a + step]
            score += weight[group] @ self.vectors[np.ix_(group, rows)]
            if threshold is not None:
                alive = score + rest[min(a + step, len(terms))] >= threshold
                rows, score = rows[alive], score[alive]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]

    def _threshold(self, weight: np.ndarray, terms: np.ndarray, own: np.ndarray, k: int) -> int | None:
        """The k-th best exact score among the first postings of the strongest terms; None if they are fewer."""
        heads = [self._head(t, weight[t], SEED_POSTINGS + k) for t in terms[:SEED_TERMS]]
        rows = np.unique(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
        rows = rows[~own[rows]]
        if len(rows) < k:
            return None
        scores = weight[terms] @ self.vectors[np.ix_(terms, rows)]
        return int(np.partition(scores, len(scores) - k)[len(scores) - k])


def top_k(queries: DataFrame, vectors: DataFrame, conf: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score) for columns vec_id and embedding of both sides."""

    def prepared(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
            "vec_id", as_integers(F.col("embedding"), conf.scale).alias("vector")
        )

    asked = prepared(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    known = prepared(vectors)
    shards = known.count() // conf.shard_rows + 1
    blocks = asked.count() // conf.block_rows + 1
    part = lambda n: F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = known.select("vec_id", "vector", part(shards).alias("shard"), every(blocks).alias("block"))
    right = asked.select("vec_id", "vector", part(blocks).alias("block"), every(shards).alias("shard"))

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not rows.num_rows or not wanted.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in names})
        shard = Shard(rows["vec_id"].to_numpy(), matrix(rows["vector"]))
        found = [
            (np.full(len(ids), query_id), ids, scores)
            for query_id, query in zip(wanted["vec_id"].to_numpy(), matrix(wanted["vector"]).T)
            for ids, scores in [shard.search(query_id, query, conf.k, conf.step)]
        ]
        return pa.table(dict(zip(names, (np.concatenate(x) for x in zip(*found)))))

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= conf.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
