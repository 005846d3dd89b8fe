"""Exact top-k inner-product search by Fagin's threshold algorithm.

Candidates are dealt to blocks of bounded size.  In a block each dimension has
its list of rows sorted by component; a query walks the lists from its better
end (by the sign of its own component), scores every newly met row in full and
stops as soon as the threshold - the score of a row that would sit at every
list's front line - is below the k-th score met so far.  Blocks of queries meet
every block of candidates; a query's block results are merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST_DEPTH = 16


def walk(x: np.ndarray, ids: np.ndarray, asc: np.ndarray, q: np.ndarray, own: int,
         k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for one query; ties go to smaller ids.

    x: rows by dimensions; asc: for each dimension the row numbers by ascending
    component.  The walk goes on while a row not yet met could still tie.
    """
    n, _ = x.shape
    up, down = np.flatnonzero(q < 0), np.flatnonzero(q > 0)
    met = np.zeros(n, bool)
    score = np.full(n, np.iinfo(np.int64).min, np.int64)
    done, depth = 0, FIRST_DEPTH
    alive = ids != own
    while True:
        depth = min(depth, n)
        fresh = np.zeros(n, bool)
        fresh[asc[done:depth, up].ravel()] = True
        fresh[asc[n - depth:n - done, down].ravel()] = True
        if depth == n:
            fresh[:] = True
        fresh &= ~met
        rows = np.flatnonzero(fresh)
        score[rows] = (x[rows] @ q).astype(np.int64)
        met |= fresh
        known = np.flatnonzero(met & alive)
        if depth == n:
            break
        if len(known) >= k:
            kth = np.partition(score[known], len(known) - k)[len(known) - k]
            front = (x[asc[depth - 1, up], up] @ q[up]) + (x[asc[n - depth, down], down] @ q[down])
            if front < kth:
                break
        done, depth = depth, depth * 2
    best = known[np.lexsort((ids[known], -score[known]))][:k]
    return ids[best], score[best]


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def _block_search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        ids = rows["id"].to_numpy().astype(np.int64)
        x, q = _matrix(rows["v"], len(ids)), _matrix(queries["v"], queries.num_rows)
        reach = float(np.abs(x).max(initial=0)) * float(np.abs(q).sum(axis=1).max(initial=0))
        if reach < 2.0 ** 53:           # doubles then hold every sum exactly
            x, q = x.astype(np.float64), q.astype(np.float64)
        asc = np.argsort(x, axis=0, kind="stable")
        out = [(qid, *walk(x, ids, asc, q[i], qid, k))
               for i, qid in enumerate(queries["id"].to_numpy().astype(np.int64))]
        return pa.table([
            pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]).astype(np.int64)),
            pa.array(np.concatenate([o[1] for o in out])),
            pa.array(np.concatenate([o[2] for o in out]))], schema=schema)
    return search


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of every vector without null or non-finite parts."""
    unfit = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (df.select(df[id_col].cast("long").alias("id"), df[vec_col].alias("raw"))
            .where(F.col("id").isNotNull() & F.col("raw").isNotNull())
            .where(~F.exists("raw", unfit))
            .select("id", F.transform("raw", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
            .distinct())


def _each(blocks: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192,
          query_rows: int = 16384) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each query.

    Both inputs are (id, v array<long>); rows with the query's id are left out,
    repeated rows count once (``integer_vectors``), vectors of another length
    than the query's never meet it, and an empty side gives no rows.  A group
    holds at most about ``block_rows`` rows and ``query_rows`` queries; rows are
    sent once per query block, queries once per row block.  Sums must fit a
    64-bit integer.
    """
    n, m = vectors.count(), queries.count()
    n_blocks, m_blocks = max(1, -(-n // block_rows)), max(1, -(-m // query_rows))
    place = lambda blocks, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(blocks))
    rows = vectors.select(
        "id", "v", F.size("v").alias("d"), place(n_blocks, 1).alias("rb"),
        _each(m_blocks).alias("qb"))
    asked = queries.select(
        "id", "v", F.size("v").alias("d"), place(m_blocks, 2).alias("qb"),
        _each(n_blocks).alias("rb"))
    found = (asked.groupBy("d", "rb", "qb").cogroup(rows.groupBy("d", "rb", "qb"))
             .applyInArrow(_block_search(k), "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
