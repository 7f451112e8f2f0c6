"""Graph operators on edge tables ``(src, dst)`` and parent tables ``(id, parent)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import new_path, release, shared_dir, written


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends are known nodes."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi").select(*edges.columns)


def prune_dangling(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges kept, and those dropped with a reason that lists the missing ends."""
    known = nodes.select("id").distinct()
    a, b = known.select(F.col("id").alias("_a")), known.select(F.col("id").alias("_b"))
    seen = edges.join(a, F.col("src") == F.col("_a"), "left").join(b, F.col("dst") == F.col("_b"), "left")
    reason = F.concat_ws(" or ", F.when(F.col("_a").isNull(), "from"), F.when(F.col("_b").isNull(), "to"))
    seen = seen.withColumn("reason", F.when(reason != "", F.concat(F.lit("unknown "), reason)))
    return seen.where("reason is null").select(*edges.columns), seen.where("reason is not null").select(*edges.columns, "reason")


def stored(edges: DataFrame, buckets: int = 64) -> DataFrame:
    """Distinct edges ``(src, dst)`` in a table of buckets of their source, sorted.

    They travel once, for this; joins and groups by ``src`` then read them as they lie, and the columns
    are compressed, which a checkpoint's are not.
    """
    path = new_path(edges.sparkSession, "edges")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    own = edges.select("src", "dst").repartition(buckets, "src").distinct()
    own.write.option("path", path).option("compression", "zstd").bucketBy(buckets, "src").sortBy("src", "dst").saveAsTable(name)
    return edges.sparkSession.table(name)


def degree(edges: DataFrame, distinct: bool = False) -> DataFrame:
    """Number of distinct neighbours each way: ``id, n_in, n_out``; ``distinct`` says that no edge is there twice."""
    e = edges.select("src", "dst") if distinct else edges.select("src", "dst").distinct()
    ends = e.select(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")).unionByName(e.select(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    return ends.groupBy("id").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"))


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without an edge."""
    return without(nodes, edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))))


def without(nodes: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes whose ``id`` isn't among ``ids``; repeats of those are put together before they travel."""
    return nodes.join(ids.select("id").distinct(), "id", "left_anti")


def hops(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """Least number of hops along the edges from ``roots(id)``, up to ``depth``: ``id, hop``.

    Each frontier is written, so that where it is small the edges are read where they lie.
    """
    frontier = written(roots.select("id").distinct().withColumn("hop", F.lit(0)))
    seen = frontier
    for k in range(1, depth + 1):
        step = edges.join(frontier.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        frontier = written(step.join(seen.select("id"), "id", "left_anti").withColumn("hop", F.lit(k)))
        seen = seen.unionByName(frontier)
    return seen


def ego(edges: DataFrame, roots: DataFrame, depth: int, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The ego graph: nodes with their column (upstream negative; ties upstream) and the edges among them.

    A root that is not in ``known(id)``, where given, fails the query.
    """
    if known is not None:
        found = roots.join(known.select("id", F.lit(True).alias("_known")).distinct(), "id", "left")
        fault = F.raise_error(F.concat(F.lit("no such node: "), F.col("id").cast("string"))).cast("boolean")
        roots = found.where(F.coalesce("_known", fault)).select("id")
    roots = written(roots.select("id").distinct())
    down = hops(edges, roots, depth).withColumnRenamed("hop", "down")
    up = hops(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), roots, depth).withColumnRenamed("hop", "up")
    nodes = written(_columns(up, down))
    return nodes, valid_edges(edges.select("src", "dst"), nodes).distinct()


def egos(edges: DataFrame, roots: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """The ego graphs of many roots at once: nodes ``(graph, id, column)`` and edges ``(graph, src, dst)``; a graph is named by its root."""
    e = edges.select("src", "dst").distinct()

    def reached(e, hop):
        frontier = roots.select(F.col("id").alias("graph"), "id").distinct().withColumn(hop, F.lit(0))
        seen = frontier
        for k in range(1, depth + 1):
            step = frontier.join(e, frontier["id"] == e["src"]).select("graph", F.col("dst").alias("id")).distinct()
            frontier = checkpointed(step.join(seen.select("graph", "id"), ["graph", "id"], "left_anti").withColumn(hop, F.lit(k)))
            seen = seen.unionByName(frontier)
        return seen

    both = reached(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")), "up").join(reached(e, "down"), ["graph", "id"], "full")
    far = F.lit(1 << 30)
    column = F.when(F.coalesce("up", far) <= F.coalesce("down", far), -F.col("up")).otherwise(F.col("down"))
    nodes = checkpointed(both.select("graph", "id", column.cast("int").alias("column")))
    inner = nodes.join(e, nodes["id"] == e["src"]).select("graph", "src", "dst")
    return nodes, inner.join(nodes.select("graph", F.col("id").alias("dst")), ["graph", "dst"], "left_semi").select("graph", "src", "dst")


#: Neighbours in one list; a node with more has several lists.
LIST = 10_000


def adjacency(edges: DataFrame, buckets: int = 64) -> DataFrame:
    """Sorted neighbour lists both ways: ``id, way, part, neighbours``, ``way`` being ``in`` or ``out``.

    A node with more than LIST edges has as many lists as keep each below some LIST, dealt by the
    neighbour's hash, so that a hub is no single row.
    """
    out, back = (_lists(edges.select(F.col(a).alias("id"), F.col(b).alias("other")), buckets) for a, b in (("src", "dst"), ("dst", "src")))
    return out.select("id", F.lit("out").alias("way"), "part", "neighbours").unionByName(back.select("id", F.lit("in").alias("way"), "part", "neighbours"))


def _lists(ends: DataFrame, buckets: int) -> DataFrame:
    """``id, part, neighbours`` of ``ends(id, other)``: only counts travel before the ends do, and those once, to buckets of their node."""
    many = written(ends.groupBy("id").agg(F.count("*").alias("_n")).where(F.col("_n") > LIST))
    dealt = ends.repartition(buckets, "id").join(F.broadcast(many), "id", "left")  # one row for LIST edges at most
    dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("other"), F.ceil(F.col("_n") / LIST)), F.lit(0)).cast("int"))
    return dealt.groupBy("id", "part").agg(F.array_sort(F.collect_set("other")).alias("neighbours"))


class Adjacency:
    """Neighbour lists stored in buckets of their node, one table for each way.

    A hop reads the tables as they lie: the frontier is brought to the buckets, and the edges are never shuffled.
    """

    def __init__(self, edges: DataFrame, buckets: int = 64):
        self.spark = edges.sparkSession
        self.names = {}
        for way, a, b in (("out", "src", "dst"), ("in", "dst", "src")):
            path = new_path(self.spark, f"adjacency-{way}")
            self.names[way] = path.rsplit("/", 1)[-1].replace("-", "_")
            own = _lists(edges.select(F.col(a).alias("id"), F.col(b).alias("other")), buckets)
            own.write.option("path", path).option("compression", "zstd").bucketBy(buckets, "id").sortBy("id").saveAsTable(self.names[way])

    def lists(self, way: str) -> DataFrame:
        return self.spark.table(self.names[way])

    def hops(self, roots: DataFrame, way: str, depth: int) -> DataFrame:
        """Least number of hops from ``roots(id)``, up to ``depth``: ``id, hop``."""
        frontier = written(roots.select("id").distinct().withColumn("hop", F.lit(0)))
        seen = frontier
        for k in range(1, depth + 1):
            step = self.lists(way).join(frontier.select("id"), "id", "left_semi").select(F.explode("neighbours").alias("id")).distinct()
            frontier = written(step.join(seen.select("id"), "id", "left_anti").withColumn("hop", F.lit(k)))
            seen = seen.unionByName(frontier)
        return seen

    def ego(self, roots: DataFrame, depth: int) -> DataFrame:
        """The ego graph's nodes with their column, as ``ego`` has them."""
        roots = written(roots.select("id").distinct())
        return _columns(self.hops(roots, "in", depth).withColumnRenamed("hop", "up"), self.hops(roots, "out", depth).withColumnRenamed("hop", "down"))

    def drop(self) -> None:
        for name in self.names.values():
            self.spark.sql(f"drop table if exists {name}")


def _columns(up: DataFrame, down: DataFrame) -> DataFrame:
    """Upstream nodes left (negative), downstream ones right; ties upstream."""
    far = F.lit(1 << 30)
    column = F.when(F.coalesce("up", far) <= F.coalesce("down", far), -F.col("up")).otherwise(F.col("down"))
    return up.join(down, "id", "full").select("id", column.cast("int").alias("column"))


def reachable(edges: DataFrame, limit: int = 64) -> DataFrame:
    """All pairs ``(a, b)`` with a path from a to b, by doubling; for graphs whose closure is small."""
    pairs = checkpointed(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct())
    n = pairs.count()
    for _ in range(limit):
        more = pairs.alias("x").join(pairs.alias("y"), F.col("x.b") == F.col("y.a")).select("x.a", "y.b")
        pairs = checkpointed(pairs.union(more).distinct())
        m = pairs.count()
        if m == n:
            break
        n = m
    return pairs


#: Rows of a task, where a table's size is known before it is dealt out.
TASK = 2_000_000


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` in as many partitions as keep each near TASK rows, where the session's own would be larger."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(rows // TASK + 1, *keys) if rows > own * TASK else df


def strong_components(edges: DataFrame) -> DataFrame:
    """Strongly connected components of more than one node: ``id, component`` (the smallest member).

    Nodes with edges both ways between them are one component, so these pairs are put together first: edges
    travel once, by their pair of ends, to find them (``_mutual``).  Edges of the rest into nodes that nothing
    leaves, and out of nodes that nothing enters, lie on no cycle and go before the rest is named by components
    (``_between``); what is left after that is a graph of components, whose own are found by ``_phases``.
    """
    e = edges.select("src", "dst").where("src is not null and dst is not null and src <> dst")
    up = F.col("src") < F.col("dst")
    ends = e.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), F.when(up, 1).otherwise(2).cast("byte").alias("way"))
    pairs = written(ends.repartition(64, "a", "b").groupBy("a", "b").agg(F.bit_or("way").alias("way")), count=F.col("way") < 3)
    both = connected(pairs.where("way = 3").select("a", "b"))
    one = pairs.where("way < 3").select(F.when(F.col("way") == 1, F.col("a")).otherwise(F.col("b")).alias("src"), F.when(F.col("way") == 1, F.col("b")).otherwise(F.col("a")).alias("dst"))
    found = _phases(_between(one, pairs.counted, both))
    release(pairs)
    if found is None:
        return both.select("id", F.col("name").alias("component"))
    # a pair's component is named by its smallest member, so the smallest name of components put together is theirs
    of = found.select(F.col("id").alias("name"), "component")
    return both.join(of, "name", "left").select("id", F.coalesce("component", "name").alias("component")).unionByName(of.join(both.select("name").distinct(), "name", "left_anti").select(F.col("name").alias("id"), "component"))


def connected(pairs: DataFrame) -> DataFrame:
    """Each node of undirected ``pairs(a, b)`` with the smallest node it is connected to: ``id, name``.

    Every node points at its smallest neighbour, if that is smaller; pointers are followed to their end, and pairs
    are named by these ends for the next round, without those that are in one.
    """
    e, names = written(pairs.where("a <> b"), count=F.lit(True)), None
    while e.counted or names is None:
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("b"))
        now = written(near.select(F.col("a").alias("id"), F.least("a", "b").alias("name")))
        moved = True
        while moved:
            # ends bear their own name: they need no look-up, and no name of many nodes is a key among ids
            on = now.where("id <> name").select(F.col("id").alias("name"), F.col("name").alias("_next"))
            then = written(now.join(on, "name", "left").select("id", F.coalesce("_next", "name").alias("name"), F.col("_next").isNotNull().alias("_moved")), count=F.col("_moved"))
            release(now)
            now, moved = then, then.counted > 0
        now_names = now.select("id", "name")
        if names is None:
            then_names = written(now_names)
        else:
            then_names = written(names.join(now_names.toDF("name", "_next"), "name", "left").select("id", F.coalesce("_next", "name").alias("name")))
            release(names)
        a, b = now_names.toDF("a", "_a"), now_names.toDF("b", "_b")
        left = written(e.join(a, "a").join(b, "b").where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), count=F.lit(True))
        release(e, now)
        e, names = left, then_names
    release(e)
    return names


def _between(one: DataFrame, rows: int, names: DataFrame) -> DataFrame:
    """Edges among the components ``names(id, name)`` of ``one(src, dst)`` that may lie on a cycle; written, with their number."""

    def named(ids):  # components of ids
        return ids.join(names, "id", "left").select(F.coalesce("name", "id").alias("name")).distinct()

    def members(found):  # all ids of components
        return found.join(names, "name", "left").select(F.coalesce("id", "name").alias("id"))

    leaving = members(named(_dealt(one.select(F.col("src").alias("id")).distinct(), rows, "id")))
    # nodes by the files of their edges would look small enough to broadcast
    leaving = _dealt(leaving.withColumnRenamed("id", "dst"), rows, "dst").hint("merge")
    e = written(_dealt(one, rows, "dst").join(leaving, "dst", "left_semi").select("src", "dst"), count=F.lit(True))
    a, b = names.toDF("src", "_src"), names.toDF("dst", "_dst")
    on = e.join(a, "src", "left").join(b, "dst", "left").select(F.coalesce("_src", "src").alias("src"), F.coalesce("_dst", "dst").alias("dst"))
    left = written(on.where("src <> dst").distinct(), count=F.lit(True))
    release(e)
    return _trimmed(left)


def _trimmed(e: DataFrame) -> DataFrame:
    """``e`` without edges out of nodes that nothing enters or into nodes that nothing leaves, as often as an eighth goes."""
    while e.counted:
        kept = e.join(e.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
        kept = written(kept.join(kept.select(F.col("dst").alias("src")).distinct(), "src", "left_semi").select("src", "dst"), count=F.lit(True))
        few = kept.counted > e.counted * 7 / 8
        release(e)
        e = kept
        if few:
            break
    return e


def _phases(e: DataFrame) -> DataFrame | None:
    """Strong components ``id, component`` of distinct written edges, which are released; None without any.

    Every phase gives the nodes random priorities and works from all local minima at once: a node's
    ``f`` is the least node that reaches it and its ``b`` the least one that it reaches over edges inside
    one ``f``.  Nodes of one component share both, and where the two are equal they are its name: those
    components leave.  Only edges inside one ``(f, b)`` go on, so that the rest falls apart as by a sort's
    pivots, in some log n phases.  Within a phase names travel by doubling (see ``_least_reaching``).
    Nodes without an edge in or out of the rest are trimmed first.

    A node with very many edges makes a large join key, which adaptive execution splits; minima are
    combined before each shuffle.
    """
    found, phase = None, 0
    while e.counted:
        f = _least_reaching(e, phase)
        inner = written(e.join(f.toDF("src", "fs"), "src").join(f.toDF("dst", "fd"), "dst").where("fs = fd").select("src", "dst"))
        b = _least_reaching(inner.select(F.col("dst").alias("src"), F.col("src").alias("dst")), phase)
        both = written(f.withColumnRenamed("name", "f").join(b.withColumnRenamed("name", "b"), "id"))
        own = both.where("f = b").select("id", F.col("f").alias("pivot"))
        found = own if found is None else found.unionByName(own)
        rest = both.where("f <> b")
        left = written(inner.join(rest.toDF("src", "fs", "bs"), "src").join(rest.toDF("dst", "fd", "bd"), "dst").where("bs = bd").select("src", "dst"), count=F.lit(True))
        release(e, f, b, inner)
        e, phase = _trimmed(left), phase + 1
    release(e)
    if found is None:
        return None
    named = found.groupBy("pivot").agg(F.min("id").alias("component"), F.count("*").alias("_n")).where("_n > 1")
    return found.join(named, "pivot").select("id", "component")


def _least_reaching(e: DataFrame, salt: int) -> DataFrame:
    """The node of the least random priority that reaches each node of the edges: ``id, name``.

    Each round takes over the names of nodes one edge before, and the name of the node that one is named
    by: what reaches my name reaches me.  So ways grow by doubling: a ring of 3,000 nodes takes 33 rounds.
    """
    rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("p"), F.col(c).alias("name"))
    # the ends of an edge need no join in the first round: both priorities follow from the ids
    own = e.select(F.col("src").alias("id"), rank("src").alias("r")).unionByName(e.select(F.col("dst").alias("id"), F.least(rank("src"), rank("dst")).alias("r")))
    now = written(own.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.p", "r.name"), count=F.lit(True))
    while now.counted:
        sent = e.join(now.withColumnRenamed("id", "src"), "src").select(F.col("dst").alias("id"), "p", "name")
        # roots bear their own name, so a name that many nodes have is no key here
        moved = now.where("name <> id").select(F.col("id").alias("_head"), F.col("p").alias("_p"), F.col("name").alias("_name"))
        jumped = now.join(moved, now["name"] == moved["_head"]).select("id", F.col("_p").alias("p"), F.col("_name").alias("name"))
        told = now.select("id", "p", "name").withColumn("was", F.col("name")).unionByName(sent.unionByName(jumped), allowMissingColumns=True)
        least = told.groupBy("id").agg(F.min(F.struct("p", "name")).alias("r"), F.max("was").alias("was"))
        then = written(least.select("id", "r.p", "r.name", "was"), count=F.col("name") != F.col("was"))
        release(now)
        now = then
    out = now.select("id", "name")
    out.written_path = now.written_path
    return out


def ancestors(parents: DataFrame) -> DataFrame:
    """Every ``(id, ancestor, hop)`` up the parent links, itself included at 0; a chain into a cycle stops at its first repeat."""
    links = parents.where("parent is not null").select(F.col("id").alias("_id"), "parent")
    level = parents.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("hop"), F.array("id").alias("path"))
    out, k = level, 0
    while True:
        k += 1
        level = level.join(links, level["ancestor"] == links["_id"]).where(~F.array_contains("path", F.col("parent"))).select("id", F.col("parent").alias("ancestor"), F.lit(k).alias("hop"), F.concat("path", F.array("parent")).alias("path"))
        level = checkpointed(level)
        if level.isEmpty():
            return out.select("id", "ancestor", "hop")
        out = out.unionByName(level)
        if k % 20 == 0:  # keeps the plan of a deep hierarchy short
            out = checkpointed(out)


def placed(parents: DataFrame) -> DataFrame:
    """``parents`` with only the links that a tree can hold: none to an undeclared id, none of an id whose chain reaches a cycle."""
    known = parents.select(F.col("id").alias("_known")).distinct()
    declared = parents.join(known, parents["parent"] == known["_known"], "left").drop("parent").withColumnRenamed("_known", "parent")
    lost = parent_cycles(declared.select("id", "parent")).select(F.col("id").alias("_lost"))
    flat = declared.join(lost, declared["id"] == lost["_lost"], "left")
    return flat.withColumn("parent", F.when(F.col("_lost").isNull(), F.col("parent"))).select(*parents.columns)


def roll_up(parents: DataFrame, counts: DataFrame) -> DataFrame:
    """Direct and total counts in a hierarchy: ``id, direct, total`` from ``counts(id, direct)``; ids whose chain reaches a cycle stand alone."""
    tree = placed(parents.select("id", "parent")).withColumn("ord", F.lit(0))
    return tour(tree, counts, ["direct"]).select("id", "direct", F.col("direct_total").alias("total"))


def numbered(df: DataFrame, order: list, number: str) -> DataFrame:
    """``df`` with each row's place in a total order, from 0; nothing is sorted in one task.

    Rows are dealt by ranges and sorted within them; how many each range has tells where it starts.
    What is written for that can be released once the result is no longer read.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = written(ranged.withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    starts = fixed.groupBy("_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))  # a row for each range
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("_range", "_first", before.alias("_before"))
    out = fixed.join(F.broadcast(starts), "_range").withColumn(number, F.col("_row") - F.col("_first") + F.col("_before")).drop("_range", "_row", "_first", "_before")
    out.written_path = fixed.written_path
    return out


def tour(tree: DataFrame, counts: DataFrame, columns: list[str]) -> DataFrame:
    """A walk of ``tree(id, parent, ord)`` in order: ``id, position, depth``, each column, and its sum over the subtree as ``<column>_total``.

    The walk's steps, one into and one out of each node, are a list whose next steps follow from first
    children and next siblings.  Sums from each step to the list's end come by pointer doubling: each round
    adds what the next pointer has and jumps to where that one points, so a tree of any shape takes
    log n rounds.  No pointer meets another, so no join has a hot key.  Ids must be unique and parents known.
    """
    base = tree.select("id", "parent", "ord").join(counts.select("id", *columns), "id", "left").select("id", "parent", "ord", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in columns])
    ordered = numbered(base, ["parent", "ord", "id"], "k")
    n = written(ordered)
    release(ordered)
    sibling = n.select((F.col("k") - 1).alias("k"), F.col("parent").alias("_of"), F.lit(True).alias("_more"))
    child = n.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.min("k").alias("_child"))
    up = n.select(F.col("id").alias("parent"), F.col("k").alias("_up"))
    linked = n.join(sibling, "k", "left").join(child, "id", "left").join(up, "parent", "left")
    into, out_of = F.col("k") * 2, F.col("k") * 2 + 1
    after = F.when(F.col("_more") & F.col("_of").eqNullSafe(F.col("parent")), (F.col("k") + 1) * 2).otherwise(F.col("_up") * 2 + 1)
    sums = ["_in", "_level", *columns]
    step = lambda at, to, inside, level, own: F.struct(at.alias("at"), to.alias("to"), F.lit(inside).cast("long").alias("_in"), F.lit(level).cast("long").alias("_level"), *[(F.col(c) if own else F.lit(0).cast("long")).alias(c) for c in columns])
    steps = written(linked.select(F.explode(F.array(step(into, F.coalesce(F.col("_child") * 2, out_of), 1, 1, True), step(out_of, after, 0, -1, False))).alias("s")).select("s.*"), count=F.col("to").isNotNull())
    while steps.counted:
        ahead = steps.select(F.col("at").alias("to"), F.col("to").alias("_to"), *[F.col(c).alias(f"_{c}") for c in sums])
        then = written(steps.join(ahead, "to", "left").select("at", F.col("_to").alias("to"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums]), count=F.col("to").isNotNull())
        release(steps)
        steps = then
    ends = steps.where("at % 2 = 1").select(F.expr("at div 2").alias("k"), *[F.col(c).alias(f"_{c}_after") for c in columns])
    starts = steps.where("at % 2 = 0").select(F.expr("at div 2").alias("k"), "_in", "_level", *[F.col(c).alias(f"_{c}_from") for c in columns])
    size = steps.agg(F.max("_in").alias("_size"))  # one row
    out = n.join(starts, "k").join(ends, "k").crossJoin(F.broadcast(size))
    return out.select("id", (F.col("_size") - F.col("_in")).alias("position"), (-F.col("_level")).cast("int").alias("depth"), *columns, *[(F.col(f"_{c}_from") - F.col(f"_{c}_after")).alias(f"{c}_total") for c in columns])


def outline(parents: DataFrame, counts: DataFrame) -> DataFrame:
    """The roll-up in the order of a walk: ``id, position, depth, direct, total, connected``.

    From ``parents(id, parent, ord)`` and ``counts(id, direct, connected)``, where ``ord`` is the order of
    declaration; ``connected`` is summed over the subtree as ``total`` is.  Positions are those of a
    pre-order walk: parents first, children as declared, and after all trees the ids whose chain reaches
    a cycle, flat at depth 0 with their own counts.  Undeclared parents make roots, and counts of
    undeclared ids are left out.
    """
    known = parents.select(F.col("id").alias("parent")).distinct()
    lost = parent_cycles(parents.join(known, "parent", "left_semi").select("id", "parent")).withColumn("_lost", F.lit(1))
    tree = placed(parents).join(lost, "id", "left").withColumn("ord", F.struct(F.coalesce("_lost", F.lit(0)).alias("lost"), F.col("ord").cast("long").alias("ord")))
    # ids out of a cycle have nothing below them, so their own counts are their totals
    return tour(tree, counts, ["direct", "connected"]).select("id", "position", "depth", "direct", F.col("direct_total").alias("total"), F.col("connected_total").alias("connected"))


def siblings(df: DataFrame, parent: str, name: str, listed: tuple[str, ...] = (), collation: str = "UNICODE") -> DataFrame:
    """``df`` with ``place`` among rows of one parent: names of the list in its order, then all others as the collation sorts them; ties by code points."""
    known = F.array_position(F.array(*map(F.lit, listed)).cast("array<string>"), F.col(name).cast("string"))
    w = Window.partitionBy(parent).orderBy(F.when(known > 0, known).otherwise(len(listed) + 1), F.collate(F.col(name), collation), F.collate(F.col(name), "UTF8_BINARY"))
    return df.withColumn("place", F.row_number().over(w))


def pruned(parents: DataFrame, counts: DataFrame) -> DataFrame:
    """The roll-up ``id, direct, total`` without zero totals: an id that is its own parent is a root with its children, and counted ids that are not declared get a root row."""
    own = parents.select("id", F.when(F.col("parent") != F.col("id"), F.col("parent")).alias("parent"))
    more = counts.select("id").distinct().join(parents.select("id"), "id", "left_anti").select("id", F.lit(None).cast(dict(parents.dtypes)["parent"]).alias("parent"))
    return roll_up(own.unionByName(more), counts).where("total > 0")


def parent_cycles(parents: DataFrame) -> DataFrame:
    """Ids whose chain of parents reaches a cycle: climbing as often as there are ids, they never get out."""
    links = checkpointed(parents.where("parent is not null").select("id", F.col("parent").alias("top")))
    n, hops_done = parents.count(), 1
    jump = links
    while hops_done <= n and not jump.isEmpty():  # doubling
        up = jump.select(F.col("id").alias("_id"), F.col("top").alias("_top"))
        jump = checkpointed(jump.join(up, jump["top"] == up["_id"]).select("id", F.col("_top").alias("top")))
        hops_done *= 2
    return jump.select("id").distinct()


def back_edges(edges: DataFrame) -> DataFrame:
    """Edges ``(graph, src, dst)`` of small graphs that close a cycle in a depth-first walk in order of ids.

    A walk is sequential, so each graph is walked in one task; the graphs are ego graphs of bounded depth
    or strong components.  A task walks one after the other as they come sorted, holding one at a time.
    """
    import itertools

    def walk(g):
        out: dict = {}
        for s, d in g:
            out.setdefault(s, []).append(d)
        state: dict = {}
        found = []
        for root in sorted({x for edge in g for x in edge}):
            if root in state:
                continue
            state[root] = 1
            stack = [(root, iter(out.get(root, ())))]
            while stack:
                at, rest = stack[-1]
                to = next(rest, None)
                if to is None:
                    state[at] = 2
                    stack.pop()
                elif state.get(to) == 1:
                    found.append((at, to))
                elif to not in state:
                    state[to] = 1
                    stack.append((to, iter(out.get(to, ()))))
        return found

    def walks(batches):
        import pyarrow as pa

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        found = ((name, *edge) for name, g in itertools.groupby(rows, lambda r: r[0]) for edge in walk([r[1:] for r in g]))
        while some := list(itertools.islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds)], names=["graph", "src", "dst"])

    from pyspark.sql.pandas.types import to_arrow_type

    own = edges.select("graph", "src", "dst")
    kinds = [to_arrow_type(f.dataType) for f in own.schema]
    return own.repartition("graph").sortWithinPartitions("graph", "src", "dst").mapInArrow(walks, own.schema)


def cycle_edges(edges: DataFrame) -> DataFrame:
    """``back_edges`` of each strong component, walked on its own from its smallest node; ``graph`` is the component.

    An edge between components closes no cycle, so nothing larger than a component meets in one task.
    """
    own = written(strong_components(edges))
    a, b = own.toDF("src", "graph"), own.toDF("dst", "_other")
    # an edge is inside a component if both ends name it: found before repeats are dropped, as few are
    inner = edges.select("src", "dst").where("src <> dst").join(a, "src").join(b, "dst").where("graph = _other").distinct()
    return back_edges(inner.select("graph", "src", "dst"))


def grid(nodes: DataFrame, pitch: int = 80, across: int = 240) -> DataFrame:
    """Places of an ego graph's nodes: columns side by side, rows centred in each column."""
    w = Window.partitionBy("column")
    row = F.row_number().over(w.orderBy("id"))
    ranks = nodes.agg(F.array_sort(F.collect_set("column")).alias("columns")).select(F.posexplode("columns").alias("place", "column"))
    placed = nodes.join(F.broadcast(ranks), "column")  # one row for each column
    return placed.select("id", "column", (F.col("place") * across).cast("double").alias("x"), ((row - (F.count("*").over(w) + 1) / 2) * pitch).cast("double").alias("y"))
