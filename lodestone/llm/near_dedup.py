"""Near-duplicate embeddings by collision-counting projections (operator 1).

Vectors are scaled to unit length, rounded to 16 bits a component and projected on many fixed
directions.  Two vectors collide on a direction if each lies in the other's window: their projections
differ by at most the window.  Pairs that collide on at least ``least`` of the sort directions are
verified by their cosine.

Which pairs are looked at: each table sorts its vectors by label, by the cells of some coarse
directions, and by the table's own sort direction; a sweep along the sorted list meets for each vector
those in its window.  ``calibrate`` sets the number of tables for a recall of 0.9995 at a cosine of
exactly the threshold (closer pairs are met more often): with 4 cells and 64 dimensions 11 tables; of
20 windows a pair at the threshold falls in too few about once in 100,000.  Each further coarse
direction about halves a cell, so the largest label's number of vectors sets how many there are.

What is shuffled: the rounded vector, once for each table; cells and projections are computed from it
again where they are needed, in whole numbers, so every task gets the same.  Rounding moves a cosine by
less than ``band``: pairs nearer to the threshold than that are told apart by the original vectors in
double precision, all others by the rounded ones.

Counting each pair once: a pair counts in the first table that meets it.  Equal vectors of one label
(told apart by 128 bits of hashes) are one entry with a number of copies.  A cell of more than BLOCK
entries is dealt in blocks, and each pair of blocks is a key of its own, so no task holds a large cell.
A sweep gives numbers for each vector and a spanning set of links, never the pairs themselves, but for
those within the band.

Defined results: a vector that is null, zero or empty, or holds null or non-finite components, and one
whose label is null, links with nothing: n_links 0, component its own id, kept.  A null id is never
linked.  Rows of equal id count as separate vectors of that id (one result row for each); vectors of
different lengths don't link.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, cut, fixed_binary, from_fixed, key_runs, mix64, partitions, root_labels, starts_of, stored

#: Least number of coarse directions, and sort directions whose windows are counted.
CELLS, SORTS = 4, 20
BLOCK = 512
#: Whole numbers that stand for 1 in a vector and in a direction.
UNIT = 32767


def calibrate(threshold: float, dimensions: int, cells: int = CELLS, recall: float = 0.9995) -> tuple[int, float, float]:
    """Tables, cell width and window for a recall at the threshold itself.

    The difference of two unit vectors at the threshold, projected on a random unit direction, is
    nearly normal with this deviation; windows take 2.5 deviations, cells are 5.35 deviations wide.
    """
    deviation = math.sqrt(max(2 - 2 * threshold, 1e-9) / dimensions)
    window, width = 2.5 * deviation, 5.35 * deviation
    met = (1 - deviation * math.sqrt(2 / math.pi) / width) ** cells * math.erf(2.5 / math.sqrt(2))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - met))), width, window


def least_collisions(sorts: int, miss: float = 1e-5) -> int:
    """The count that a pair at the threshold falls short of with at most this probability."""
    inside = math.erf(2.5 / math.sqrt(2))
    tail = [math.comb(sorts, k) * inside**k * (1 - inside) ** (sorts - k) for k in range(sorts + 1)]
    return max([k for k in range(1, sorts + 1) if sum(tail[:k]) <= miss], default=1)


def directions(dimensions: int, tables: int, cells: int, sorts: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Directions of every table's cells (tables * cells) and sort directions, of which table t uses the t-th; whole numbers."""
    rng = np.random.default_rng(seed)
    need = tables * cells + sorts
    rows: list[np.ndarray] = []
    while len(rows) < need:
        rows += list(np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0])
    whole = np.rint(np.array(rows[:need]) * UNIT)
    return whole[: tables * cells], whole[tables * cells :]


def usable(vector: str) -> Column:
    """Whether a vector takes part: neither null, empty or zero, nor with null or non-finite components."""
    inf = float("inf")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (x != inf) & (x != -inf)
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rounded(batches):
    """Unit vectors of whole 16-bit components; the largest component is scaled first, so no square overflows."""
    for b in batches:
        if not b.num_rows:
            continue
        v = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
        v = v / np.abs(v).max(1, keepdims=True)
        q = np.rint(v / np.sqrt((v**2).sum(1, keepdims=True)) * UNIT).astype("i2")
        yield pa.record_batch({**{k: b.column(k) for k in ("vec_id", "label", "h1", "h2")}, "q": fixed_binary(q)})


def near_duplicates(rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows ``(vec_id, n_links, component_id, kept)``, one for each row of the input."""
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v")
    # zero has two signs, of which one is kept, so that equal vectors have equal keys
    good = base.where(takes_part).withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    good = good.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(7), "v"))
    rest = base.where(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    # one row for each vector length (usually there is one), with its largest label
    sizes = good.groupBy(F.size("v").alias("d"), "label").count().groupBy("d").agg(F.max("count").alias("most")).collect()
    parts = [_linked(good.where(F.size("v") == r["d"]), r["d"], r["most"], threshold) for r in sizes]
    out = rest
    for own in parts:
        out = out.unionByName(own)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _linked(good: DataFrame, d: int, most: int, threshold: float) -> DataFrame:
    """Rows ``(vec_id, n_links, component_id)`` of the vectors of one length."""
    key = ["label", "h1", "h2"]
    rounded = good.mapInArrow(_rounded, "vec_id long, label long, h1 long, h2 long, q binary")
    entries = rounded.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("q").alias("q"))
    entries = stored(entries.withColumn("eid", F.monotonically_increasing_id()))
    swept = stored(_sweep(entries, d, most, threshold))
    sure = swept.where("other is null")
    # pairs too near to the threshold for rounded vectors: few, and so are their vectors
    doubtful = swept.where("other is not null").select("eid", "other")
    ends = doubtful.select("eid").union(doubtful.select("other")).distinct()
    named = stored(entries.join(ends, "eid", "left_semi").select("eid", "copies", *key))
    vectors = good.select(*key, "v").join(named, key).dropDuplicates(["eid"])
    side = lambda n: vectors.select(F.col("eid").alias(f"e{n}"), F.col("copies").alias(f"c{n}"), F.col("v").alias(f"v{n}"))
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
    dot = lambda a, b: total(F.zip_with(a, b, lambda x, y: x * y))
    scaled = lambda v: F.transform(v, lambda x: x / F.array_max(F.transform(v, F.abs)))
    pairs = doubtful.join(side(1), F.col("eid") == F.col("e1")).join(side(2), F.col("other") == F.col("e2"))
    pairs = pairs.withColumn("v1", scaled(F.col("v1"))).withColumn("v2", scaled(F.col("v2")))
    proven = cut(pairs.where(dot("v1", "v2") / (F.sqrt(dot("v1", "v1")) * F.sqrt(dot("v2", "v2"))) >= threshold).select("e1", "c1", "e2", "c2"))
    counted = sure.select("eid", "links").union(proven.select("e1", "c2")).union(proven.select("e2", "c1"))
    links = counted.groupBy("eid").agg(F.sum("links").alias("links"))
    edges = sure.where("eid <> root").select(F.col("eid").alias("a"), F.col("root").alias("b")).union(proven.select("e1", "e2"))
    grouped = components(edges).withColumnRenamed("node", "eid")
    smallest = grouped.join(entries.select("eid", "rep"), "eid").groupBy("component").agg(F.min("rep").alias("least"))
    found = entries.select(*key, "eid", "rep", "copies").join(links, "eid", "left").join(grouped.join(smallest, "component"), "eid", "left")
    found = found.select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id"))
    return good.select("vec_id", *key).join(found, key).select("vec_id", "n_links", "component_id")


def _sweep(entries: DataFrame, d: int, most: int, threshold: float) -> DataFrame:
    """Rows ``(eid, links, root, other)``: partial numbers of links with a spanning set of links to a
    root, and, with ``other``, pairs that only the original vectors can tell."""
    cells = max(CELLS, math.ceil(math.log(max(most / BLOCK, 1)) / math.log(2)))
    cells = min(cells, max(1, d - 1))
    tables, width, window = calibrate(threshold, d, cells)
    sorts = max(SORTS, tables)
    least = least_collisions(sorts)
    by_cell, by_sort = directions(d, tables, cells, sorts)
    one = float(UNIT) ** 2
    shifts = np.rint(np.random.default_rng(2).random(tables * cells) * width * one)
    wide, reach = np.rint(width * one), np.rint(window * one)
    odd = mix64(np.arange(1, cells + 1, dtype="u8")) | np.uint64(1)
    # a rounded vector is off by half a unit in each component, and its direction by twice that at most
    band = 5 * math.sqrt(d) * 0.5 / UNIT

    def keys_of(q):
        # sums of whole numbers below 2^53: the same in every task, in whatever order they are added
        cell = np.floor((q @ by_cell.T + shifts) / wide).astype("i8").view("u8").reshape(len(q), tables, cells)
        return (mix64(cell) * odd).sum(2, dtype="u8")

    def cells_of(b, q):
        label = mix64(b.column("label").to_numpy().view("u8"))
        return mix64(keys_of(q) ^ (label[:, None] + mix64(np.arange(1, tables + 1, dtype="u8")))).view("i8")

    def project(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                some = b.slice(lo, 2000)
                q = from_fixed(some.column("q"), "i2").astype("f8")
                found, at = cells_of(some, q), q @ by_sort.T
                for t in range(tables):
                    yield pa.record_batch({"cell": found[:, t], "t": np.full(len(q), t, "i4"), "at": at[:, t].astype("i8"), **{k: some.column(k) for k in ("eid", "copies", "q")}})

    def only_cells(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                some = b.slice(lo, 2000)
                yield pa.record_batch({"cell": cells_of(some, from_fixed(some.column("q"), "i2").astype("f8")).ravel()})

    def sweep(batches):
        for run in key_runs(batches, ["cell", "first", "second"], 8192):
            n = run.num_rows
            col = lambda k: run.column(k).to_numpy()
            eid, copies, block, t, at = (col(k) for k in ("eid", "copies", "block", "t", "at"))
            group = np.repeat(np.arange(len(s := starts_of(col("cell"), col("first"), col("second")))), np.diff(np.r_[s, n]))
            if len(s) == n:
                continue
            cross = col("first") != col("second")
            q = from_fixed(run.column("q"), "i2").astype("f8")
            keys, places, norm = keys_of(q), q @ by_sort.T, np.sqrt((q**2).sum(1))
            links = np.zeros(n, "i8")
            a, b, doubt_a, doubt_b = [], [], [], []
            alive = np.arange(n)
            for step in range(1, n):
                alive = alive[alive + step < n]
                j = alive + step
                alive = alive[(group[alive] == group[j]) & (at[j] - at[alive] <= reach)]
                if not len(alive):
                    break
                i, j = alive, alive + step
                ok = ~(cross[i] & (block[i] == block[j]))
                i, j = i[ok], j[ok]
                close = np.abs(places[i] - places[j]) <= reach
                ok = close.sum(1) >= least
                i, j, close = i[ok], j[ok], close[ok]
                cosine = (q[i] * q[j]).sum(1) / (norm[i] * norm[j])
                ok = cosine > threshold - band
                i, j, close, cosine = i[ok], j[ok], close[ok], cosine[ok]
                # the first table that meets the pair counts it
                ok = ((keys[i] == keys[j]) & close[:, :tables]).argmax(1) == t[i]
                i, j, cosine = i[ok], j[ok], cosine[ok]
                doubtful = cosine < threshold + band
                doubt_a.append(i[doubtful])
                doubt_b.append(j[doubtful])
                i, j = i[~doubtful], j[~doubtful]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                a.append(i)
                b.append(j)
            label = root_labels(n, np.concatenate(a), np.concatenate(b)) if a else np.arange(n)
            some = links > 0
            doubt = (np.concatenate(doubt_a), np.concatenate(doubt_b)) if doubt_a else (np.arange(0), np.arange(0))
            none = np.zeros(len(doubt[0]), "i8")
            other = pa.array(np.r_[eid[some], eid[doubt[1]]], mask=np.r_[np.ones(some.sum(), bool), none.astype(bool)])
            yield pa.record_batch({"eid": np.r_[eid[some], eid[doubt[0]]], "links": np.r_[links[some], none], "root": np.r_[eid[label][some], eid[doubt[0]]], "other": other})

    dealt = entries.select("eid", "label", "copies", "q").mapInArrow(project, "cell long, t int, at long, eid long, copies long, q binary")
    # only the cells that need more than one block are named
    large = entries.select("label", "q").mapInArrow(only_cells, "cell long").groupBy("cell").agg(F.count("*").alias("size")).where(F.col("size") > BLOCK)
    large = stored(large.select("cell", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    many = dealt.join(large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    many = many.withColumn("block", F.pmod(F.xxhash64("eid", F.lit(3)), F.col("blocks")).cast("int"))
    others = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("first"), F.greatest("block", k).alias("second"))))
    pairs = many.withColumn("_p", others).select("cell", "_p.first", "_p.second", "block", "t", "at", "eid", "copies", "q")
    ordered = pairs.repartition(partitions(entries.sparkSession), "cell", "first", "second").sortWithinPartitions("cell", "first", "second", "at", "eid")
    return ordered.mapInArrow(sweep, "eid long, links long, root long, other long")


def op1_near_dedup(spark, sf_dir):
    """Near duplicates among all rows of ``embeddings`` at a cosine of 0.93."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
