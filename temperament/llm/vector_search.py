"""Exact top-k inner products by the threshold algorithm.

Vectors are cut into blocks; a block keeps, per dimension, its vectors sorted by that component. A query walks all lists
of a block from the end that favours it, scores exactly what it meets for the first time, and stops once the sum of the
components reached, the most that any vector not yet met can score, is below its kth result. The results of
one block are the start for the next, so later blocks often end at once. Queries and blocks meet in pairs of
bounded size; every task keeps k results per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS = 4096  # vectors of a block
QUERIES = 1024  # queries of a block
STREAMS = 32  # tasks that share the blocks for one block of queries
_EXACT = 1 << 53
_LONG = (-(1 << 63), (1 << 63) - 1)
_FIELDS = "key int, ids binary, width int, table binary"


def _packed(key, ids, vectors):
    """One row: a block of vectors as a matrix of whole numbers, short vectors filled with zeros."""
    width = max(map(len, vectors))
    table = np.zeros((len(ids), width))
    for at, vector in enumerate(vectors):
        table[at, : len(vector)] = vector
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key], pa.int32()),
            pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
            pa.array([width], pa.int32()),
            pa.array([table.tobytes()], pa.binary()),
        ],
        names=["key", "ids", "width", "table"],
    )


def _blocks(rows: int):
    """Pack rows of equal `key`, which stand together, into blocks of at most `rows`."""

    def run(batches):
        key, ids, vectors = None, [], []
        for batch in batches:
            columns = batch.column("key").to_pylist(), batch.column("vec_id").to_pylist()
            for at, name, vector in zip(*columns, batch.column("vector").to_numpy(zero_copy_only=False)):
                if ids and (at != key or len(ids) == rows):
                    yield _packed(key, ids, vectors)
                    ids, vectors = [], []
                key = at
                ids.append(name)
                vectors.append(vector)
        if ids:
            yield _packed(key, ids, vectors)

    return run


def _best(scores, ids, k: int):
    """The k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k + 64 and isinstance(scores, np.ndarray) and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    return scores[order], ids[order]


class SortedBlock:
    """A block of vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, table: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.table = ids[order], table[order]
        self.lists = np.argsort(-self.table, axis=0, kind="stable")
        self.values = np.take_along_axis(self.table, self.lists, axis=0)
        self.size = float(np.abs(self.table).max(initial=0))

    def search(self, query_id: int, query: np.ndarray, k: int, scores, ids):
        """Merge this block into the k best of a query so far; the query's own row is left out."""
        width = min(len(query), self.table.shape[1])
        query = query[:width]
        if self.size * float(np.abs(query).max(initial=0)) * max(width, 1) >= _EXACT:
            return self._large(query_id, query, k, scores, ids)
        used = np.flatnonzero(query)
        weight = query[used]
        count = len(self.ids)
        met = np.zeros(count, bool)
        met[np.searchsorted(self.ids, query_id, "left") : np.searchsorted(self.ids, query_id, "right")] = True
        depth, done = 0, 0
        while done < count:
            depth = min(count, max(16, 4 * depth)) if len(used) else count
            if len(used):
                # what stands before `depth` in the lists, from the top for positive weights, else from the end
                up, down = used[weight > 0], used[weight < 0]
                found = np.concatenate((self.lists[done:depth, up].ravel(), self.lists[count - depth : count - done, down].ravel()))
                fresh = np.zeros(count, bool)
                fresh[found] = True
                fresh = np.flatnonzero(fresh & ~met)
            else:
                fresh = np.flatnonzero(~met)
            if len(fresh):
                met[fresh] = True
                own = self.table[fresh, :width] @ query
                # only what can still enter is merged
                if len(ids) == k:
                    may = own >= scores[-1]
                    own, fresh = own[may], fresh[may]
                if len(fresh):
                    scores, ids = _best(np.concatenate((scores, own)), np.concatenate((ids, self.ids[fresh])), k)
            done = depth
            if done < count and len(ids) == k:
                bound = weight[weight > 0] @ self.values[depth - 1, up] + weight[weight < 0] @ self.values[count - depth, down]
                if bound < scores[-1]:
                    break
        return scores, ids

    def _large(self, query_id, query, k, scores, ids):
        """Whole numbers beyond what a double holds exactly: the same scores in Python's integers, cut to the range of a long."""
        whole = [int(x) for x in query]
        own = np.array([min(max(sum(int(a) * b for a, b in zip(row, whole)), _LONG[0]), _LONG[1]) for row in self.table], object)
        other = self.ids != query_id
        return _best(np.concatenate((np.array([int(s) for s in scores], object), own[other])), np.concatenate((ids, self.ids[other])), k)


def _searched(k: int):
    def run(batches):
        current, queries, best = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["query_block"], row["stream"], row["query_ids"])
                if key != current:
                    if current is not None:
                        yield _results(queries[0], best)
                    current = key
                    width = row["query_width"]
                    queries = np.frombuffer(row["query_ids"], np.int64), np.frombuffer(row["query_table"]).reshape(-1, width)
                    best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in queries[0]]
                block = SortedBlock(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["table"]).reshape(-1, row["width"]))
                best = [block.search(q, v, k, *b) for q, v, b in zip(queries[0].tolist(), queries[1], best)]
        if current is not None:
            yield _results(queries[0], best)

    return run


def _results(query_ids, best):
    sizes = [len(ids) for _, ids in best]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(query_ids, sizes), pa.int64()),
            pa.array([int(i) for _, ids in best for i in ids], pa.int64()),
            pa.array([int(s) for scores, _ in best for s in scores], pa.int64()),
        ],
        names=["query_id", "vec_id", "score"],
    )


def whole_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and `vector`: floor(scale * x) of every component x as double; vectors that are null or hold null or non-finite components are left out."""
    number = lambda x: x.cast("double")
    bad = lambda x: x.isNull() | F.isnan(number(x)) | (F.abs(number(x)) == float("inf"))
    kept = vectors.where(F.col("embedding").isNotNull() & ~F.exists("embedding", bad))
    kept = kept.where(F.col("vec_id").isNotNull())
    top = 1.7e308

    def whole(x):
        scaled = F.greatest(F.least(number(x) * scale, F.lit(top)), F.lit(-top))
        # from 2^53 on a double is whole
        return F.when(F.abs(scaled) < _EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("vector"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k rows of `vectors` (vec_id, vector of whole numbers) with the highest inner product, for every row of `queries`.

    Returns query_id, rank (from 1), vec_id, score; ties to the smaller vec_id, fewer rows if there are fewer vectors. A query's
    own vec_id is left out. Missing components of shorter vectors count as zero; empty vectors score 0. Repeated vec_ids are
    rows of their own. Scores beyond the range of a long are cut to it.
    """
    query_blocks = max(1, -(-queries.count() // QUERIES))
    asked = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("key"))
    asked = asked.repartition("key").sortWithinPartitions("key").mapInArrow(_blocks(QUERIES), _FIELDS)
    asked = asked.select(
        F.col("key").alias("query_block"), F.explode(F.sequence(F.lit(0), F.lit(STREAMS - 1))).alias("stream"),
        F.col("ids").alias("query_ids"), F.col("width").alias("query_width"), F.col("table").alias("query_table"),
    )
    blocks = vectors.select("vec_id", "vector", F.lit(0).alias("key")).mapInArrow(_blocks(ROWS), _FIELDS)
    blocks = blocks.select(
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        F.pmod(F.xxhash64("ids"), F.lit(STREAMS)).cast("int").alias("stream"), "ids", "width", "table",
    )
    met = asked.join(blocks, ["query_block", "stream"]).sortWithinPartitions("query_block", "stream", "query_ids")
    best = met.mapInArrow(_searched(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
