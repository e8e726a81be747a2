"""Clustering of integer vectors around centroids, exact, with a filter in rotated coordinates.

1. Vectors become integers.  Their counts, sums and products, added up over all rows,
   give the covariance; its eigenvectors, strongest first, are a rotation.
2. Every vector is written once with its leading rotated coordinates and the norm
   of the rest (``lead`` of them hold most of the distance between vectors).
3. For a vector x and a centroid c, the squared distance of the leading
   coordinates plus the squared difference of the two rest norms is never above the
   squared distance, as a rotation keeps distances and the rests differ by their
   norms at least.  The centroid of the least bound is measured in integers; only
   centroids whose bound does not exceed that distance are measured as well.
4. A round adds up the members of every centroid per batch, then over all rows, in
   integers.  No more than the sums by centroid reach the driver.

Rounding cannot change a result: bounds are lowered by far more than doubles can
be off, and every distance that decides is worked out in integers.

Results: one row per vector that takes part, repeated rows included.  Vectors that are
null, of another length, or hold a null or non-finite component take no part, nor do
those with a component beyond 2**27 after scaling, whose squared distances would not
fit a long.  Rows without an id are clustered, but start no centroid.  Starting
vectors are taken by the hash of their id, then by id and by components; repeated rows
may start equal centroids, of which the smaller number gets the members.  With fewer
vectors than centroids there are as many centroids as vectors; an empty table gives
no rows.  Other columns of the input, whatever their names, are left out.
"""

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.session import discard, materialize, scratch_dir

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Rotated coordinates that are stored.
LEAD = 16
#: Largest component; 64 squared differences of such fit a long.
LARGEST = 1 << 27
#: Vectors that are worked on at once.
BATCH = 8192


def integers(rows: DataFrame, id_col="vec_id", vec_col="embedding", scale=SCALE, dimensions=DIMENSIONS) -> DataFrame:
    """``vec_id`` and ``v``, the vectors that take part as integers floor(scale * x)."""
    vector = F.col(vec_col).cast("array<double>")
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LARGEST)
    return (
        rows.filter((F.size(vector) == dimensions) & F.forall(vector, fits))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x * scale).cast("int")).alias("v"))
    )


def start_order(vec_id: Column, seed: int = 1) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def starting(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors of the smallest hashes, in that order."""
    first = (
        vectors.filter("vec_id is not null")
        .select(start_order(F.col("vec_id"), seed).alias("hash"), "vec_id", "v")
        .orderBy("hash", "vec_id", "v")
        .limit(k)
        .collect()
    )
    return np.array([row.v for row in first], np.int64)


def _matrix(column, dimensions: int) -> np.ndarray:
    """The vectors of an Arrow list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def _parts(batches, dimensions: int):
    """Ids and vectors of the batches, some thousand rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part, _matrix(part.column("v"), dimensions)


def rotation(vectors: DataFrame, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and orthonormal directions (columns), strongest first, of all vectors.

    Every batch gives its count, sums and products as one row per cell; Spark adds
    up the cells, of which there are some 4,000 whatever the size of the table.
    """

    def moments(batches):
        total = np.zeros((dimensions + 1, dimensions + 1))
        for _, v in _parts(batches, dimensions):
            padded = np.hstack([v.astype(np.float64), np.ones((len(v), 1))])
            total += padded.T @ padded
        if total[-1, -1]:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["cell", "value"])

    cells = vectors.select("v").mapInArrow(moments, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((dimensions + 1) ** 2)
    for row in cells:
        total[row.cell] = row.value
    total = total.reshape(dimensions + 1, dimensions + 1)
    n = max(total[-1, -1], 1)
    mean = total[-1, :-1] / n
    _, directions = np.linalg.eigh(total[:-1, :-1] / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(directions[:, ::-1])


def rotated(v: np.ndarray, mean: np.ndarray, directions: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading coordinates and the norm of the rest."""
    y = (v - mean) @ directions
    return y[:, :lead], np.sqrt(np.einsum("ij,ij->i", y[:, lead:], y[:, lead:]))


def indexed(vectors: DataFrame, mean: np.ndarray, directions: np.ndarray, lead: int) -> DataFrame:
    """Vectors with their leading coordinates and rest norm."""

    def rotate(batches):
        for part, v in _parts(batches, len(mean)):
            y, rest = rotated(v, mean, directions, lead)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), lists, pa.array(rest)], ["vec_id", "v", "lead", "rest"])

    return vectors.mapInArrow(rotate, "vec_id long, v array<int>, lead array<double>, rest double")


def nearest(
    v: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Per vector the nearest centroid and the squared distance to it, and how many distances were measured.

    Ties go to the smaller number.
    """
    size = np.einsum("ij,ij->i", lead, lead)[:, None] + np.einsum("ij,ij->i", c_lead, c_lead)[None, :]
    bound = size - 2 * (lead @ c_lead.T) + (rest[:, None] - c_rest[None, :]) ** 2
    # what rounding can be off grows with the numbers that cancel
    bound -= 1e-9 * (size + rest[:, None] ** 2 + c_rest[None, :] ** 2) + 1e-3
    rows = np.arange(len(v))
    first = np.argmin(bound, axis=1)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[rows, first] = ((v - centroids[first]) ** 2).sum(axis=1)
    survives = bound <= exact[rows, first][:, None]
    survives[rows, first] = False
    for j in np.flatnonzero(survives.any(axis=0)):
        i = np.flatnonzero(survives[:, j])
        exact[i, j] = ((v[i] - centroids[j]) ** 2).sum(axis=1)
    best = np.argmin(exact, axis=1)
    return best, exact[rows, best], len(v) + int(survives.sum())


def _assigning(centroids: np.ndarray, mean: np.ndarray, directions: np.ndarray, lead: int):
    """A function from batches of the index to vectors with their nearest centroids."""
    c_lead, c_rest = rotated(centroids, mean, directions, lead)

    def assign(batches):
        for part, v in _parts(batches, centroids.shape[1]):
            y = part.column("lead").flatten().to_numpy().reshape(len(v), -1)
            yield part, v, *nearest(v, y, part.column("rest").to_numpy(), centroids, c_lead, c_rest)

    return assign


def updated(index: DataFrame, centroids: np.ndarray, assign) -> np.ndarray:
    """Every centroid replaced by the floor of the mean of its members; one without members stays."""
    k, dimensions = centroids.shape

    def sums(batches):
        total, count = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for _, v, best, _, _ in assign(batches):
            np.add.at(total, best, v)
            count += np.bincount(best, minlength=k)
        some = np.flatnonzero(count)
        cells = [pa.array(some, pa.int32()), pa.array(count[some]), *[pa.array(total[some, d]) for d in range(dimensions)]]
        yield pa.RecordBatch.from_arrays(cells, names)

    names = ["cluster", "n", *[f"s{d}" for d in range(dimensions)]]
    partial_sums = index.select("vec_id", "v", "lead", "rest").mapInArrow(sums, "cluster int, " + ", ".join(f"{name} long" for name in names[1:]))
    total = partial_sums.groupBy("cluster").agg(*[F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in names[1:]])
    after = centroids.copy()
    for row in total.collect():
        after[row[0]] = [int(s) // int(row[1]) for s in row[2:]]
    return after


def fingerprint(centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    rows: DataFrame,
    id_col="vec_id",
    vec_col="embedding",
    k=CENTROIDS,
    rounds=ROUNDS,
    scale=SCALE,
    dimensions=DIMENSIONS,
    lead=LEAD,
    seed=1,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` per vector, as a written table, and the centroids."""
    spark = rows.sparkSession
    vectors = integers(rows, id_col, vec_col, scale, dimensions)
    centroids = starting(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), centroids.reshape(0, dimensions)
    mean, directions = rotation(vectors, dimensions)
    folder = scratch_dir(spark, "centroids")
    index = materialize(indexed(vectors, mean, directions, lead), "index", below=folder)
    assigning = partial(_assigning, mean=mean, directions=directions, lead=lead)
    for _ in range(rounds):
        centroids = updated(index, centroids, assigning(centroids))
    last = assigning(centroids)

    def label(batches):
        for part, _, best, distance, _ in last(batches):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    labelled = materialize(index.mapInArrow(label, "vec_id long, cluster int, distance long"), "clustered")
    discard(spark, folder)
    return labelled, centroids


def summarised(labelled: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Vectors with the inertia of their cluster and of all, and a fingerprint of their centroid."""
    spark = labelled.sparkSession
    sums = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    inertia = {row.cluster: int(row.inertia) for row in sums}
    known = [(c, d, sum(inertia.values()), fingerprint(centroids[c].tolist())) for c, d in sorted(inertia.items())]
    about = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # a row per centroid, so its size is known
    return labelled.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
