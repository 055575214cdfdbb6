"""Exact top-k search by inner product, pruned with multi-resolution segment statistics.

A vector is cut into 1, 4 and then 16 segments.  The distance of two vectors is
at least what the means and deviations of their segments differ by,

    d(q, x)**2 >= sum over segments of  L * ((mean_q - mean_x)**2 + (dev_q - dev_x)**2),

and the inner product is (|q|**2 + |x|**2 - d**2) / 2, so the bound on the
distance bounds the score from above.  Candidates go through the resolutions
coarse to fine; only those whose bound reaches the query's k-th best score so
far are scored exactly.

Queries come in blocks, vectors in chunks.  Every chunk meets every block of
the stated query set, one pair of them at a time in a task, and passes on at
most k rows for each query (all that tie with the k-th are looked at; ties go to
the smaller id).  The survivors of all chunks are merged by query.

Scores are integers.  They are computed in doubles where these are exact, and
in 64-bit integers otherwise; bounds are loosened by more than the rounding of
their sums.

Defined cases: null vectors and vectors with a null or non-finite component
take no part, nor do null ids; vectors of another length than the query's are
no candidates; repeated rows are rows of their own, and a query's candidates
are all rows but one copy of its own; an empty table gives an empty result;
other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, table

LEVELS = (1, 4, 16)
BLOCK, CHUNK = 512, 4096


def _segments(size: int, parts: int) -> list[tuple[int, int]]:
    bounds = np.linspace(0, size, min(parts, size) + 1).astype(int)
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b > a]


def segment_statistics(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that plain distances of rows bound the vectors' distances."""
    columns = []
    for a, b in _segments(vectors.shape[1], parts):
        part = vectors[:, a:b]
        mean = part.mean(1)
        columns.append(mean * np.sqrt(b - a))
        columns.append(np.sqrt(((part - mean[:, None]) ** 2).sum(1)))
    return np.stack(columns, 1)


def best_of_chunk(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, the k best rows of the chunk, and their scores.

    ``own`` and ``rows`` are row numbers; a query's own row is left out.
    """
    largest = max(float(np.abs(queries).max(initial=0)), float(np.abs(vectors).max(initial=0)))
    exact = largest * largest * queries.shape[1] < 2.0**53
    q, x = queries.astype(float), vectors.astype(float)
    norm_q, norm_x = (q * q).sum(1), (x * x).sum(1)
    # (|q|^2 + |x|^2 - |a - b|^2) / 2 is a . b, as the statistics of a vector keep its norm
    stats_q, stats_x = [segment_statistics(q, p) for p in LEVELS], [segment_statistics(x, p) for p in LEVELS]
    coarse = [a @ b.T for a, b in zip(stats_q[:2], stats_x[:2])]
    seen = max(k + 1, min(len(rows), 64))
    for n in range(len(q)):
        slack = 1e-9 * (norm_q[n] + norm_x) + 1e-6
        first = np.argpartition(-coarse[1][n], seen - 1)[:seen] if seen < len(rows) else np.arange(len(rows))
        score = (x[first] @ q[n]) if exact else (vectors[first] @ queries[n])
        score = score[rows[first] != own[n]]
        left = np.arange(len(rows))
        if len(score) >= k:
            floor = float(np.partition(score, len(score) - k)[len(score) - k])
            for bound in coarse:
                left = left[bound[n, left] + slack[left] >= floor]
            left = left[stats_x[2][left] @ stats_q[2][n] + slack[left] >= floor]
        left = left[rows[left] != own[n]]
        score = (x[left] @ q[n]).astype(np.int64) if exact else vectors[left] @ queries[n]
        order = np.lexsort((rows[left], ids[left], -score))[:k]
        yield n, left[order], score[order]


def valid_vectors(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(row_no, id, vector): the rows that take part, scaled to integers, numbered in the order of the input's parts."""
    whole = F.transform(F.col(column), lambda c: F.floor(F.lit(64.0) * c.cast("double")))
    usable = (F.col(key).isNotNull() & F.col(column).isNotNull() & (F.size(column) > 0)
              & ~F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return vectors.where(usable).select(F.monotonically_increasing_id().alias("row_no"), F.col(key).cast("long").alias("id"), whole.alias("vector"))


def _packed(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Blocks of up to ``size`` rows of one dimension as binary columns."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            lengths = np.asarray(vectors.value_lengths())
            flat, offset = vectors.flatten().to_numpy(), np.concatenate(([0], np.cumsum(lengths)))
            numbers, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim in np.unique(lengths).tolist():
                every = np.flatnonzero(lengths == dim)
                for at in range(0, len(every), size):
                    some = every[at:at + size]
                    block = flat[(offset[some][:, None] + np.arange(dim)).ravel()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(numbers[some[0]])]), pa.array([dim], pa.int32()), pa.array([numbers[some].tobytes()]),
                         pa.array([ids[some].tobytes()]), pa.array([block.tobytes()])], schema=out)

    out = pa.schema([(f"{name}_no", pa.int64()), ("dim", pa.int32()), (f"{name}_rows", pa.binary()), (f"{name}_ids", pa.binary()), (f"{name}_data", pa.binary())])
    return rows.mapInArrow(pack, f"{name}_no long, dim int, {name}_rows binary, {name}_ids binary, {name}_data binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The k rows with the largest inner products for every row that ``is_query`` selects.

    Returns query_row, query_id, rank (from 1), id and score.  Blocks of queries
    meet chunks of vectors by a join on the query block's number; a chunk is
    sent once to each block of the stated query set.
    """
    rows = materialize(valid_vectors(vectors, key, column), "vectors")
    queries = rows.where(is_query)
    blocks = materialize(_packed(queries.repartition(1 + queries.count() // BLOCK), "block", BLOCK), "query-blocks")
    chunks = _packed(rows.repartition(1 + rows.count() // CHUNK), "chunk", CHUNK)
    # the block numbers, one for some hundred queries, go along with every chunk
    numbers = blocks.groupBy("dim").agg(F.collect_list("block_no").alias("numbers"))
    meeting = (chunks.join(numbers, "dim").withColumn("block_no", F.explode("numbers")).drop("numbers")
               .join(blocks.drop("dim"), "block_no"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                dim = r["dim"]
                q_rows, q_ids = np.frombuffer(r["block_rows"], np.int64), np.frombuffer(r["block_ids"], np.int64)
                x_rows, x_ids = np.frombuffer(r["chunk_rows"], np.int64), np.frombuffer(r["chunk_ids"], np.int64)
                q = np.frombuffer(r["block_data"], np.int64).reshape(-1, dim)
                x = np.frombuffer(r["chunk_data"], np.int64).reshape(-1, dim)
                found = list(best_of_chunk(q, q_rows, x, x_rows, x_ids, k))
                count = [len(best) for _, best, _ in found]
                query = np.repeat(np.arange(len(found)), count)
                best = np.concatenate([b for _, b, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_rows[query]), pa.array(q_ids[query]), pa.array(x_rows[best]), pa.array(x_ids[best]),
                     pa.array(np.concatenate([s for _, _, s in found]))], names=["query_row", "query_id", "row_no", "id", "score"])

    found = meeting.select("dim", "block_rows", "block_ids", "block_data", "chunk_rows", "chunk_ids", "chunk_data").mapInArrow(
        search, "query_row long, query_id long, row_no long, id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id", "row_no")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_row", "query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4_topk(spark, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every vector whose id is divisible by 20."""
    found = top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
