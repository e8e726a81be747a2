"""Nearest neighbours by a block matrix join over quantised vectors.

Queries and candidates are dealt at random into row and column groups of a
matrix; each cell meets the queries of one group with the candidates of
another.  In a cell, products of 8-bit vectors (exact in 32-bit floats for up
to 1,040 components at once) give an approximate distance of each pair, and the
quantisation errors of its two vectors bound how far that is off.  Pairs whose
lower bound exceeds the k-th upper bound, or the k-th distance found so far, are
dropped; distances of the others are worked out from the original vectors in
double precision and kept in a heap per query.  The heaps of the cells are
merged at the end.  Bounds are safe, so no neighbour is lost: recall is 1.
Vectors of single precision travel as such, so cells hold twice as many of them.

Vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part; vectors of different lengths are not compared.  Of
rows with the same id the smallest vector counts.  Ties go to the smaller id.
"""

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of vectors that a cell holds of either side.
CELL_BYTES = 24 << 20
#: Rows and columns of a product tile.
TILE = (256, 4096)
#: Candidate groups at least, so that small tables use several tasks.
LEAST_GROUPS = 12


def width_of(table: DataFrame, vector_col: str) -> int:
    """Bytes of a component: 4 if the vectors are of single precision."""
    kind = table.schema[vector_col].dataType
    return 4 if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else 8


def valid(table: DataFrame, id_col: str, vector_col: str, width=8) -> DataFrame:
    vector = F.col(vector_col).cast("array<float>" if width == 4 else "array<double>")
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def quantise(x: np.ndarray):
    """8-bit vectors, their scales, squared norms and distances from the originals, a tile at a time in double precision."""
    q, scale, norm, error = np.empty(x.shape, np.int8), np.empty(len(x)), np.empty(len(x)), np.empty(len(x))
    for at in range(0, len(x), TILE[1]):
        own = slice(at, at + TILE[1])
        exact = x[own].astype(np.float64)
        top = np.abs(exact).max(axis=1)
        with np.errstate(over="ignore", under="ignore", divide="ignore", invalid="ignore"):
            scale[own] = np.where(top / 127 > 0, top / 127, 1.0)
            q[own] = np.clip(np.rint(exact / scale[own, None]), -127, 127)
            error[own] = np.sqrt(((exact - q[own] * scale[own, None]) ** 2).sum(axis=1)) * (1 + 1e-12)
        norm[own] = (q[own].astype(np.float64) ** 2).sum(axis=1)
    return q, scale, norm, error


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of 8-bit vectors, 1,024 components at a time."""
    total = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        total += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return total


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row in double precision, added in the order of the components."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        for d in range(x.shape[1]):
            total += (x[:, d].astype(np.float64) - y[:, d]) ** 2
    return np.sqrt(total)


@np.errstate(over="ignore", invalid="ignore")
def search_cell(q_ids, q, c_ids, c, k: int):
    """The k nearest candidates of each query in a cell, as (query, distance, id) lists."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in q_ids]
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    qq, qs, qn, qe = quantise(q)
    cq, cs, cn, ce = quantise(c)
    for r in range(0, len(q), TILE[0]):
        rows = slice(r, r + TILE[0])
        for s in range(0, len(c), TILE[1]):
            cols = slice(s, s + TILE[1])
            # components near the limits of doubles overflow here; such pairs are worked out exactly
            square = (qs[rows] ** 2 * qn[rows])[:, None] + (cs[cols] ** 2 * cn[cols])[None, :]
            cross = 2 * qs[rows][:, None] * cs[cols][None, :] * products(qq[rows], cq[cols])
            # rounding of the three terms, as a bound on the square
            slack = 1e-13 * (square + np.abs(cross))
            error = qe[rows][:, None] + ce[cols][None, :]
            low = np.sqrt(np.maximum(square - cross - slack, 0)) - error
            high = np.sqrt(np.maximum(square - cross + slack, 0)) + error
            own = q_ids[rows][:, None] == c_ids[cols][None, :]
            high[own] = np.inf
            high[np.isnan(high)] = np.inf
            low[~np.isfinite(low)] = -np.inf
            reach = np.partition(high, k - 1, axis=1)[:, k - 1] if k <= high.shape[1] else np.full(len(high), np.inf)
            best = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps[rows]])
            row, col = np.nonzero((low <= np.minimum(reach, best)[:, None] * (1 + 1e-12)) & ~own)
            for part in range(0, len(row), 1 << 16):
                i, j = row[part : part + (1 << 16)] + r, col[part : part + (1 << 16)] + s
                d = distances(q[i], c[j])
                by = np.lexsort((c_ids[j], d, i))
                i, j, d = i[by], j[by], d[by]
                first = np.r_[True, i[1:] != i[:-1]]
                nth = np.arange(len(i)) - np.maximum.accumulate(np.where(first, np.arange(len(i)), 0))
                for a, b, x in zip(i[nth < k].tolist(), c_ids[j[nth < k]].tolist(), d[nth < k].tolist()):
                    entry = (-x, -b)
                    if len(heaps[a]) < k:
                        heapq.heappush(heaps[a], entry)
                    elif entry > heaps[a][0]:
                        heapq.heapreplace(heaps[a], entry)
    return [(int(q_ids[a]), -x, -b) for a, h in enumerate(heaps) for x, b in h]


def search(queries: DataFrame, candidates: DataFrame, k=10, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest candidates."""
    size = max(width_of(queries, vector_col), width_of(candidates, vector_col))
    own = valid(queries, id_col, vector_col, size)
    others = valid(candidates, id_col, vector_col, size)
    n_own, n_others, width = (
        own.agg(F.count("id").alias("n"), F.lit(0).alias("m"), F.max("dim").alias("d"))
        .union(others.agg(F.lit(0), F.count("id"), F.max("dim")))
        .agg(F.sum("n"), F.sum("m"), F.max("d"))
        .first()
    )
    room = max(1, CELL_BYTES // (size * (width or 1)))
    columns = max(LEAST_GROUPS, math.ceil((n_others or 0) / room))
    rows = max(1, math.ceil((n_own or 0) / room))

    def dealt(df, mine, n_mine, other, n_other):
        return df.withColumn(mine, F.pmod(F.xxhash64("id"), F.lit(n_mine)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        )

    left = dealt(own, "r", rows, "c", columns).groupBy("dim", "r", "c")
    right = dealt(others, "c", columns, "r", rows).groupBy("dim", "r", "c")

    def cell(key, a, b):
        dim = key[0].as_py()

        def vectors(t):
            flat = t.column("v").combine_chunks()
            flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
            return t.column("id").to_numpy(), flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

        found = search_cell(*vectors(a), *vectors(b), k) if a.num_rows and b.num_rows else []
        ids, scores, others = zip(*found) if found else ((), (), ())
        return pa.table(
            {"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(others, pa.int64()), "score": pa.array(scores, pa.float64())}
        )

    found = left.cogroup(right).applyInArrow(cell, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
