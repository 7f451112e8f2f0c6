"""Nearest neighbours by inner product along shifted space-filling curves (operator 2).

1. Vectors are projected on a few directions, shifted by a different amount for each curve, and given
   the Hilbert key of their cell.  Every curve is sorted by a range partitioning in Spark; each query
   meets the vectors in a window of keys around its own.  The windows of all curves merge, and the best
   ``k`` by the exact inner product are kept.
2. Windows find nearly all neighbours where vectors crowd together, but not in data that fills its
   dimensions evenly, where no curve can.  So the k-th score found is taken as a bound, and the rows,
   which lie on the first curve in runs of RUN neighbours, are looked through run by run: a run whose
   centre and radius show that none of its rows can beat the bound is skipped, and the others are
   scored.  The result is then exact, whatever the data; the windows decide how much is skipped.

Queries are a stated share of the rows and go to every shard of rows in blocks; a shard keeps at most
``k`` results for each query, and these are merged.  Sums run in double precision on the original
vectors, component by component in the same order for every pair, so that equal vectors tie exactly.

Defined results: vectors that are null, zero, empty, or hold null or non-finite components take no
part, nor do null ids; a query's own row (rows of its id) is no candidate; equal scores go to the
smaller id; fewer candidates than ``k`` give fewer rows; vectors of different lengths don't meet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fixed_binary, from_fixed, partitions
from .near_dedup import usable

CURVES, AXES, BITS = 4, 6, 8
WINDOW = 128
RUN = 256
SHARD_ROWS = 16_384
QUERY_BLOCK = 4_096


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with integer coordinates, by the published transposition."""
    x = cells.astype("i8").T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve_keys(v: np.ndarray, d: int, curves: int = CURVES) -> np.ndarray:
    """Each vector's key on each curve: fixed random directions, a shift for each curve."""
    rng = np.random.default_rng(22)
    axes = min(AXES, d)
    out = np.empty((len(v), curves), "i8")
    scale = np.sqrt((v**2).sum(1, keepdims=True))
    unit = v / scale
    for c in range(curves):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0][:axes]
        spread = 3.0 / np.sqrt(d)
        at = (unit @ turn.T + spread) / (2 * spread) * (1 << (BITS - 1)) + rng.random(axes) * (1 << (BITS - 1))
        out[:, c] = hilbert(np.clip(at, 0, (1 << BITS) - 1), BITS)
    return out


def inner(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of every query with every row: components are added in order, so equal rows tie."""
    out = np.zeros((len(q), len(rows)))
    for j in range(q.shape[1]):
        out += q[:, j, None] * rows[None, :, j]
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: largest score, then smallest id."""
    if len(scores) > 4 * k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= bound)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)`` for the rows where ``is_query`` holds, against all rows."""
    good = rows.where(F.col(id_col).isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("q"), F.col(vector_col).cast("array<double>").alias("v"))
    sizes = [r["d"] for r in good.select(F.size("v").alias("d")).distinct().collect()]
    found = [_search(good.where(F.size("v") == d), d, k) for d in sizes]
    if not found:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _windows(good: DataFrame, d: int, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows on all curves, and the neighbours ``(query_id, vec_id, score)`` that the windows find."""
    spark = good.sparkSession

    def keyed(batches):
        for b in batches:
            if b.num_rows:
                v = b.column("v").flatten().to_numpy().reshape(-1, d)
                keys = curve_keys(v, d)
                for c in range(CURVES):
                    yield pa.record_batch({"curve": np.full(len(v), c, "i4"), "key": keys[:, c], "id": b.column("id"), "q": b.column("q"), "v": fixed_binary(v)})

    def windows(batches):
        tables = [b for b in batches if b.num_rows]
        held = pa.Table.from_batches(tables[:0], schema=arrow)
        for i, b in enumerate([*tables, None]):
            # a window reaches over the end of a batch: its tail stays for the next
            if b is not None:
                held = pa.concat_tables([held, pa.Table.from_batches([b])]).combine_chunks()
                if held.num_rows < 8 * WINDOW and i + 1 < len(tables):
                    continue
            n = held.num_rows
            if b is None or not n:
                break
            last = i + 1 == len(tables)
            ids, curve, query = held.column("id").to_numpy(), held.column("curve").to_numpy(), held.column("q").to_numpy()
            v = from_fixed(held.column("v"), "f8")
            out: list[tuple[int, int, float]] = []
            for r in np.flatnonzero(query[: n if last else n - WINDOW]):
                lo, hi = max(0, r - WINDOW), min(n, r + WINDOW + 1)
                near = np.arange(lo, hi)
                near = near[(curve[lo:hi] == curve[r]) & (ids[lo:hi] != ids[r])]
                s = inner(v[r : r + 1], v[near])[0]
                out += [(int(ids[r]), int(ids[near[x]]), float(s[x])) for x in best(s, ids[near], k)]
            if out:
                yield pa.record_batch({"query_id": [o[0] for o in out], "vec_id": [o[1] for o in out], "score": [o[2] for o in out]})
            held = held.slice(max(0, n - 2 * WINDOW))
            if not last:
                mask = held.column("q").to_numpy().copy()
                mask[: max(0, len(mask) - WINDOW)] = False  # those queries have had their window
                held = held.set_column(held.schema.get_field_index("q"), "q", pa.array(mask))

    arrow = pa.schema([("curve", pa.int32()), ("key", pa.int64()), ("id", pa.int64()), ("q", pa.bool_()), ("v", pa.binary())])
    schema = "curve int, key long, id long, q boolean, v binary"
    n = partitions(spark)
    curves = cut(good.mapInArrow(keyed, schema).repartitionByRange(n, "curve", "key", "id").sortWithinPartitions("curve", "key", "id"))
    near = curves.mapInArrow(windows, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return curves, cut(near)


def _search(good: DataFrame, d: int, k: int) -> DataFrame:
    curves, near = _windows(good, d, k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select("query_id", F.col("score").alias("bound"))

    own = curves.where("curve = 0")
    total = own.count()
    shards = max(1, -(-total // SHARD_ROWS))
    # shards follow the curve by its keys' quantiles; equal keys are dealt by id
    cuts = sorted(set(own.select(F.percentile_approx("key", [(i + 1) / shards for i in range(shards - 1)], 10_000)).first()[0])) if shards > 1 else []
    place = F.lit(0)
    if cuts:
        place = F.size(F.filter(F.lit(cuts), lambda c: c < F.col("key")))
    sized = own.withColumn("shard", place)
    crowd = sized.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("parts"))
    by_shard = sized.join(crowd, "shard").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    queries = own.where("q").select(F.col("id").alias("query_id"), "v").distinct().join(first, "query_id", "left")
    # the stated query set meets every shard of rows in blocks of some QUERY_BLOCK queries; there is one row for each shard
    blocks = max(1, -(-own.where("q").count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).cast("int"))
    by_block = by_shard.select("shard", "part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "key", "id", "v")
    shard_list = crowd.select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    everywhere = queries.crossJoin(shard_list).select("query_id", "v", "bound", "shard", "part", "block").toDF("query_id", "v", "bound", "to_shard", "to_part", "to_block")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_id, out_s = [], [], []
        if left.num_rows and right.num_rows:
            right = right.sort_by([("key", "ascending"), ("id", "ascending")])
            ids, v = right.column("id").to_numpy(), from_fixed(right.column("v"), "f8")
            starts = np.arange(0, len(ids), RUN)
            centre = np.add.reduceat(v, starts) / np.diff(np.r_[starts, len(ids)])[:, None]
            radius = np.sqrt(np.maximum.reduceat(((v - np.repeat(centre, np.diff(np.r_[starts, len(ids)]), 0)) ** 2).sum(1), starts))
            qid, q = left.column("query_id").to_numpy(), from_fixed(left.column("v"), "f8")
            bound = left.column("bound").to_numpy(zero_copy_only=False).astype("f8")
            bound = np.where(np.isnan(bound), -np.inf, bound)
            length, reach = np.sqrt((q**2).sum(1)), np.sqrt((v**2).sum(1).max())
            open_run = q @ centre.T + length[:, None] * radius[None] + 1e-9 * (1 + np.abs(np.where(np.isfinite(bound), bound, 0)) + length * reach)[:, None] >= bound[:, None]
            kept_s = np.full((len(q), k), -np.inf)
            kept_id = np.full((len(q), k), np.iinfo("i8").max)
            for r, lo in enumerate(starts):
                hi = min(lo + RUN, len(ids))
                who = np.flatnonzero(open_run[:, r])
                if not len(who):
                    continue
                rough = q[who] @ v[lo:hi].T
                floor = np.maximum(bound[who], kept_s[who, -1])
                hit_q, hit_r = np.nonzero(rough >= (floor - 1e-9 * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)) + length[who] * reach))[:, None])
                ok = ids[lo:hi][hit_r] != qid[who][hit_q]
                hit_q, hit_r = hit_q[ok], hit_r[ok]
                exact = np.zeros(len(hit_q))
                for j in range(d):
                    exact += q[who[hit_q], j] * v[lo + hit_r, j]
                edges = np.searchsorted(hit_q, np.arange(len(who) + 1))
                for w in np.flatnonzero(np.diff(edges)):
                    own_hits = slice(edges[w], edges[w + 1])
                    s, i = np.r_[kept_s[who[w]], exact[own_hits]], np.r_[kept_id[who[w]], ids[lo + hit_r[own_hits]]]
                    top = best(s, i, k)
                    kept_s[who[w]], kept_id[who[w]] = s[top], i[top]
            some = np.isfinite(kept_s)
            out_q, out_id, out_s = np.repeat(qid, some.sum(1)), kept_id[some], kept_s[some]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_id, pa.int64()), "score": pa.array(out_s, pa.float64())})

    rest = everywhere.groupBy("to_shard", "to_part", "to_block").cogroup(by_block.groupBy("shard", "part", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    # a row of equal id in two places is one candidate; what the windows found takes part
    both = near.unionByName(rest).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_ann(spark, sf_dir):
    """The 20 nearest by inner product of every row of ``embeddings`` whose id is divisible by 20."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
