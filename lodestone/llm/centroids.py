"""Centroid clustering of integer vectors with block-norm screening (operator 12).

Vectors are compressed once to integer components with the norms of their segments.  By the
Cauchy-Schwarz inequality two segments are at least as far apart as their norms, so the norms alone
bound a vector's distance to each centroid from below.  The centroid of the least bound is measured
first; only those whose bound doesn't exceed that distance get exact integer distances.

A round sends the centroids to the tasks (their number is a parameter) and gets back sums: each task
adds up its vectors by cluster before anything is shuffled, so a cluster of a third of all rows costs no
more than another.  Vectors never leave the table that compression wrote.

Defined results: vectors that are null, of another length, or hold a null or non-finite component take no
part; zero vectors do.  Rows that repeat an id or a vector are vectors of their own, ties go to the
smaller centroid, a vector without an id never starts a centroid; columns of other names are
ignored; with fewer vectors than centroids each starts one; an empty table gives no rows.  A component
beyond 2^27 after scaling stops the job, for distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import release, stored

SEGMENT = 8
LARGEST = 1 << 27
SLICE = 2048


def compress(vectors: DataFrame, dims: int = 64, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows ``(id_col, body, norms)``: integer components floor(scale * x) as 32-bit, and each segment's norm as a double."""
    kind, id_type = to_arrow_type(vectors.schema[id_col].dataType), dict(vectors.dtypes)[id_col]
    whole = vectors.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias("v"))
    fit = whole.where((F.size("v") == dims) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    edges = np.arange(0, dims, SEGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                part = b.slice(at, SLICE)
                x = np.floor(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
                if len(x) and np.abs(x).max() > LARGEST:
                    raise OverflowError(f"a scaled component is beyond {LARGEST}")
                whole = x.astype("i8")
                norms = np.sqrt(np.add.reduceat(whole * whole, edges, axis=1).astype("f8"))
                yield pa.record_batch([part.column(0).cast(kind), _bytes(whole.astype("<i4")), _bytes(norms)], names=[id_col, "body", "norms"])

    return fit.mapInArrow(run, f"`{id_col}` {id_type}, body binary, norms binary")


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def bounds(norms: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """Lower bounds of squared distances, vectors by centroids, rounded down beyond any error of doubles."""
    out = np.zeros((len(norms), len(of_centroids)))
    for s in range(norms.shape[1]):
        a, b = norms[:, s, None], of_centroids[None, :, s]
        gap = np.maximum(np.abs(a - b) - 1e-14 * (a + b), 0)
        out += gap * gap
    return out * (1 - 1e-12)


def nearest(x: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each vector's centroid and exact squared distance, and how many distances were measured."""
    edges = np.arange(0, x.shape[1], SEGMENT)
    low = bounds(norms, np.sqrt(np.add.reduceat(centroids * centroids, edges, axis=1).astype("f8")))
    best = low.argmin(axis=1)
    gap = x - centroids[best]
    distance = np.einsum("ij,ij->i", gap, gap)
    first, measured = best.copy(), len(x)
    for c in range(len(centroids)):
        open_rows = np.flatnonzero((low[:, c] <= distance) & (first != c))
        gap = x[open_rows] - centroids[c]
        d = np.einsum("ij,ij->i", gap, gap)
        measured += len(d)
        better = (d < distance[open_rows]) | (d == distance[open_rows]) & (c < best[open_rows])
        rows = open_rows[better]
        best[rows], distance[rows] = c, d[better]
    return best, distance, measured


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    dims = centroids.shape[1]
    width = len(range(0, dims, SEGMENT))
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            part = b.slice(at, SLICE)
            x = _matrix(part.column("body"), "<i4", dims).astype("i8")
            best, distance, _ = nearest(x, _matrix(part.column("norms"), "<f8", width), centroids)
            yield part, x, best, distance


def _moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: the floor of each cluster's mean; an empty cluster's centroid stays."""
    shared = table.sparkSession.sparkContext.broadcast(centroids)
    k, dims = centroids.shape

    def run(batches):
        sums, counts = np.zeros((k, dims), "i8"), np.zeros(k, "i8")
        for _, x, best, _ in _assigned(batches, shared.value):
            np.add.at(sums, best, x)
            counts += np.bincount(best, minlength=k)
        some = np.flatnonzero(counts)
        flat = np.c_[counts[some], sums[some]].ravel()
        yield pa.record_batch({"cluster": np.repeat(some, dims + 1), "part": np.tile(np.arange(dims + 1), len(some)), "total": flat})

    total = table.select("body", "norms").mapInArrow(run, "cluster long, part long, total long").groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    found = {(r["cluster"], r["part"]): int(r["total"]) for r in total.collect()}  # k times (dims + 1) numbers
    shared.unpersist()
    out = centroids.copy()
    for c in range(k):
        if (c, 0) in found:
            out[c] = [found[c, d + 1] // found[c, 0] for d in range(dims)]
    return out


def seeds(table: DataFrame, k: int, seed: int, id_col: str, dims: int) -> np.ndarray:
    """The vectors of the k smallest hashes of ``seed:id``; of equal ids, by components."""
    rows = table.where(F.col(id_col).isNotNull()).select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256).alias("h"), "body").orderBy("h", "body").limit(k).collect()
    return np.array([np.frombuffer(r["body"], "<i4") for r in rows], "i8").reshape(-1, dims)


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """Rows ``(id_col, cluster, distance)`` after the last round, and the final centroids in integers."""
    spark = vectors.sparkSession
    kind, id_type = to_arrow_type(vectors.schema[id_col].dataType), dict(vectors.dtypes)[id_col]
    table = stored(compress(vectors, dims, scale, id_col, vec_col))
    centroids = seeds(table, k, seed, id_col, dims)
    if not len(centroids):
        release(table)
        return spark.createDataFrame([], f"`{id_col}` {id_type}, cluster int, distance long"), centroids
    for _ in range(rounds):
        centroids = _moved(table, centroids)
    shared = spark.sparkContext.broadcast(centroids)

    def run(batches):
        for part, _, best, distance in _assigned(batches, shared.value):
            yield pa.record_batch([part.column(0).cast(kind), pa.array(best.astype("i4")), pa.array(distance)], names=[id_col, "cluster", "distance"])

    out = stored(table.mapInArrow(run, f"`{id_col}` {id_type}, cluster int, distance long"))
    release(table)
    return out, centroids


def described(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds each cluster's and the whole table's sum of distances, and the digest of the centroid."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row for each centroid
    total = sum(int(r["s"]) for r in sums)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(r["cluster"], int(r["s"]), total, digest[r["cluster"]]) for r in sums]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster")


def op12_centroids(spark, sf_dir):
    """Forty clusters of the 64-component ``embeddings`` in five rounds."""
    assigned, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return described(assigned, centroids).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_sql(k: int = 40, rounds: int = 5) -> str:
    """The same rounds one after the other, every vector against every centroid."""
    steps = [f"""v as materialized (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
    where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
c0 as materialized (select row_number() over (order by h, v) - 1 as c, v as m from (select sha256('2:' || cast(vec_id as varchar)) as h, v from v where vec_id is not null order by h, v limit {k}))"""]  # fmt: skip
    near = """a{n} as materialized (select vec_id, v, min(struct_pack(d := d, c := c)) as b from (
    select vec_id, v, r, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) as d from (select *, row_number() over () as r from v), c{n}) group by r, vec_id, v)"""
    mean = """c{n} as materialized (select c, coalesce(any_value(x), any_value(m)) as m from c{p} left join (
    select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as x from (select b.c as c, i, sum(v[i]) as s, count(*) as n from a{p}, range(1, 65) t(i) group by 1, 2) group by c) using (c) group by c)"""
    for r in range(rounds):
        steps += [near.format(n=r), mean.format(n=r + 1, p=r)]
    steps.append(near.format(n=rounds))
    return "with " + ",\n".join(steps) + f"""
select vec_id, cast(b.c as integer) as cluster, cast(b.d as bigint) as distance, cast(sum(b.d) over (partition by b.c) as bigint) as cluster_inertia, cast(sum(b.d) over () as bigint) as inertia, sha256(array_to_string(m, ',')) as centroid_sha256
from a{rounds} join c{rounds} on b.c = c"""
