"""Strong components against brute force, on random graphs, long rings and chains."""

import random

from lodestone.operators import graph as G


def components(edges):
    """By reach sets."""
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
        out.setdefault(b, set())

    def reach(a):
        seen, todo = set(), [a]
        while todo:
            for y in out[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return seen

    seen = {a: reach(a) for a in out}
    return {a: min(own) for a in out if len(own := {b for b in seen[a] if a in seen[b]} | {a}) > 1}


def found(spark, edges, kind="long"):
    df = spark.createDataFrame(edges, f"src {kind}, dst {kind}")
    return {r["id"]: r["component"] for r in G.strong_components(df).collect()}


def test_components_of_random_graphs(spark):
    for seed, n, m in ((1, 60, 70), (2, 60, 100), (3, 40, 200)):
        rng = random.Random(seed)
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        assert found(spark, edges + edges[:5]) == components(edges)


def test_components_of_texts_nulls_and_nothing(spark):
    edges = [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("d", "c"), ("x", "x"), (None, "a"), ("a", None)]
    assert found(spark, edges, "string") == {"a": "a", "b": "a", "c": "c", "d": "c"}
    assert found(spark, []) == {} and found(spark, [(1, 2), (2, 3)]) == {}


def test_names_travel_a_long_ring_by_doubling(spark, monkeypatch):
    """A ring of 3,000 nodes in random order settles in a few rounds, not in as many as its length."""
    ring = random.Random(5).sample(range(10**6), 3000)
    writes = []
    real = G.written
    monkeypatch.setattr(G, "written", lambda *a, **b: writes.append(1) or real(*a, **b))
    assert found(spark, [*zip(ring, ring[1:] + ring[:1]), (ring[0], -1), (-1, -2)]) == dict.fromkeys(ring, min(ring))
    assert len(writes) < 100


def walked(tree, direct):
    """Pre-order with depths and sums, by recursion without a stack limit."""
    below = {}
    for i, parent, o in sorted(tree, key=lambda x: (x[2], x[0])):
        below.setdefault(parent, []).append(i)
    out, todo = [], [(i, 0) for i in reversed(below.get(None, []))]
    while todo:
        i, depth = todo.pop()
        out.append([i, depth, direct.get(i, 0), direct.get(i, 0)])
        todo += [(c, depth + 1) for c in reversed(below.get(i, []))]
    up, row = {i: p for i, p, _ in tree}, {r[0]: r for r in out}
    for i, *_ in reversed(out):
        if up[i] is not None:
            row[up[i]][3] += row[i][3]
    return [(i, k, *rest) for k, (i, *rest) in enumerate(out)]


def toured(spark, tree, direct):
    got = G.tour(spark.createDataFrame(tree, "id string, parent string, ord long"), spark.createDataFrame(list(direct.items()) or [("none", 1)], "id string, direct long"), ["direct"])
    return sorted(got.select("id", "position", "depth", "direct", "direct_total").collect(), key=lambda r: r[1])


def test_a_tour_is_the_walk_of_a_random_forest(spark):
    rng = random.Random(3)
    names = [f"n{k}" for k in range(300)]
    rng.shuffle(names)
    tree = [(n, rng.choice(names[max(0, k - 40) : k]) if k and rng.random() < 0.95 else None, rng.randrange(9)) for k, n in enumerate(names)]
    direct = {n: rng.randrange(5) for n in names[::2]} | {"stranger": 9}
    assert [tuple(r) for r in toured(spark, tree, direct)] == walked(tree, direct)


def test_a_tour_of_a_deep_chain_a_flat_tree_and_nothing(spark):
    """Ten thousand levels need no more rounds than ten thousand children."""
    chain = [(f"c{k}", f"c{k - 1}" if k else None, 0) for k in range(10_000)]
    got = toured(spark, chain, {"c9999": 1, "c5": 2})
    assert [(r["id"], r["depth"]) for r in got] == [(f"c{k}", k) for k in range(10_000)] and [r["direct_total"] for r in got[:7]] == [3] * 6 + [1]
    flat = [("root", None, 0)] + [(f"c{k}", "root", -k) for k in range(3000)]
    got = toured(spark, flat, {})
    assert [r["id"] for r in got[:3]] == ["root", "c2999", "c2998"] and {r["depth"] for r in got[1:]} == {1}
    assert toured(spark, [], {}) == []


def test_neighbour_lists_of_a_hub_are_several_and_hops_shuffle_no_edge(spark, monkeypatch, capsys):
    from test_operators import brute_ego

    monkeypatch.setattr(G, "LIST", 10)
    edges = {(0, k) for k in range(1, 40)} | {(k, k + 1) for k in range(1, 30)} | {(5, 0), (7, 0)}
    df = spark.createDataFrame(sorted(edges) + [(0, 1)], "src long, dst long")
    lists = G.adjacency(df).collect()
    hub = [r["neighbours"] for r in lists if (r["id"], r["way"]) == (0, "out")]
    assert len(hub) > 2 and sorted(x for part in hub for x in part) == list(range(1, 40)) and all(p == sorted(p) for p in hub)
    store = G.Adjacency(df, buckets=4)
    try:
        for root in (0, 5, 12):
            assert dict(store.ego(spark.createDataFrame([(root,)], "id long"), 2).collect()) == brute_ego(edges, root, 2)[0]
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        store.lists("out").join(spark.createDataFrame([(0,)], "id long"), "id", "left_semi").explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan  # the frontier alone is brought to the buckets
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        store.drop()


def test_siblings_stand_as_readers_sort_them(spark):
    names = ["zebra", "Éclair", "eclipse", "apple", "Öl", "oak", "second", "first"]
    df = spark.createDataFrame([("p", n) for n in names], "parent string, name string")
    got = [r["name"] for r in G.siblings(df, "parent", "name", ("first", "second")).orderBy("place").collect()]
    assert got == ["first", "second", "apple", "Éclair", "eclipse", "oak", "Öl", "zebra"]


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_pairs_that_point_at_each_other_need_no_phases(spark, monkeypatch):
    """Stars and chains of such pairs, joined by edges one way, are named before any name has to travel."""
    monkeypatch.setattr(G, "_least_reaching", None)
    pairs = [(9, k) for k in range(20, 25)] + [(20, 30), (30, 31), (50, 51), (60, 61)]
    edges = [*pairs, *((b, a) for a, b in pairs), (24, 50), (50, 60), (1, 9), (61, 70), (7, 7)]
    assert found(spark, edges) == components(edges)


def test_a_cycle_over_pairs_is_one_component(spark):
    edges = [(5, 6), (6, 5), (6, 8), (8, 9), (9, 8), (9, 3), (3, 5), (9, 40), (40, 41), (41, 40)]
    assert found(spark, edges) == components(edges)


def test_connected_nodes_of_random_pairs(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    got = dict(G.connected(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == components([(a, b) for a, b in pairs] + [(b, a) for a, b in pairs])


def test_walks_of_graphs_share_tasks(spark, capsys):
    edges = [(g, a, b) for g in range(500) for a, b in ((1, 2), (2, 3), (3, 1))]
    df = G.back_edges(spark.createDataFrame(edges, "graph long, src long, dst long"))
    assert sorted(map(tuple, df.collect())) == [(g, 3, 1) for g in range(500)]
    assert "FlatMapGroupsInPandas" not in plan_of(df, capsys)


def test_ends_are_put_together_before_they_meet_the_nodes(spark, capsys):
    nodes, edges = spark.createDataFrame([(k,) for k in range(5)], "id long"), spark.createDataFrame([(1, 2)] * 50, "src long, dst long")
    df = G.orphans(nodes, edges)
    assert sorted(r["id"] for r in df.collect()) == [0, 3, 4] and "HashAggregate" in plan_of(df, capsys)


def test_stored_edges_are_distinct_and_not_shuffled_again(spark, capsys):
    e = G.stored(spark.createDataFrame([(1, 2), (1, 2), (2, 3)], "src long, dst long"), buckets=4)
    assert sorted(map(tuple, e.collect())) == [(1, 2), (2, 3)]
    assert "Exchange" not in plan_of(e.groupBy("src").count(), capsys)
