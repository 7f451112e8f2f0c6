import difflib
import random

from pyspark.sql import functions as F

from lodestone import queries
from lodestone.functions import text
from lodestone.operators import graph, match, merge


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_ego_ties_go_upstream_and_diamond_keeps_inner_edge(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("b", "c"), ("d", "a")], "src string, dst string")
    nodes, edges = graph.ego(e, spark.createDataFrame([("a",)], "id string"), 2)
    assert dict(nodes.collect()) == {"a": 0, "b": 1, "c": 1, "d": -1}
    assert ("b", "c") in rows(edges)


def test_strong_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 7)], "src int, dst int")
    assert rows(graph.strong_components(e)) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]


def test_parent_cycles_reach(spark):
    h = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a"), ("d", None), ("e", "d"), ("s", "s")], "id string, parent string")
    assert [r[0] for r in rows(graph.parent_cycles(h))] == ["a", "b", "c", "s"]


def test_back_edges_self_loop_and_cycle(spark):
    e = spark.createDataFrame([(0, 1, 2), (0, 2, 3), (0, 3, 1), (0, 2, 2)], "graph int, src int, dst int")
    assert rows(graph.back_edges(e)) == [(0, 2, 2), (0, 3, 1)]


def test_overlay_explicit_null_wins_and_position_stays(spark):
    base = spark.createDataFrame([("x", "n1", 5), ("y", "n2", 6)], "id string, name string, _ord int")
    over = spark.createDataFrame([("x", None, 1, ["name"]), ("z", "n3", 2, ["name"]), ("y", "no", 3, [])], "id string, name string, _ord int, _set array<string>")
    assert rows(merge.overlay(base, over, "id", ["name"]).select("id", F.coalesce("name", F.lit("-")), "_new", "_ord")) == [("x", "-", 0, 5), ("y", "n2", 0, 6), ("z", "n3", 1, 2)]


def test_match_longest_first_no_overlap(spark):
    t = spark.createDataFrame([(1, "Great Anvil and anvil, anvils"), (2, None)], "id int, text string")
    v = spark.createDataFrame([("anvil", 1), ("great anvil", 2), ("AN", 3)], "surface string, target int")
    assert rows(match.match(t, v, "id", "text").select("start", "target")) == [(0, 2), (16, 1)]


def test_plain_wikitext(spark):
    d = spark.createDataFrame([("'''A''' [[File:x.png]] {{Keyword|Big|B}} [[P|label]] {{other|{{in}}}}<br>z <!-- c -->",)], "t string")
    assert d.select(text.plain_wikitext(F.col("t"))).first()[0] == "A B label z"


def brute_ego(e, root, depth):
    def reached(e):
        hop, now = {root: 0}, {root}
        for k in range(1, depth + 1):
            now = {d for s, d in e if s in now} - set(hop)
            hop |= dict.fromkeys(now, k)
        return hop

    down, up = reached(e), reached({(d, s) for s, d in e})
    ids = {i: -up[i] if up.get(i, 99) <= down.get(i, 99) else down[i] for i in up.keys() | down.keys()}
    return ids, {(s, d) for s, d in e if s in ids and d in ids}


def brute_back(edges):
    found, state = set(), {}

    def walk(at):
        state[at] = 1
        for s, d in sorted(edges):
            if s == at and state.get(d) == 1:
                found.add((s, d))
            elif s == at and d not in state:
                walk(d)
        state[at] = 2

    for n in sorted({x for p in edges for x in p}):
        if n not in state:
            walk(n)
    return found


def test_cycle_edges_of_components(spark):
    """Each component is walked on its own; edges between components and self edges close nothing."""
    e = {(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 7), (8, 8), (7, 9), (9, 6), (9, 7), (1, 3), (5, 6)}
    own = [{1, 2, 3}, {4, 5}, {6, 7, 9}]
    want = {(min(c), *b) for c in own for b in brute_back(sorted((s, d) for s, d in e if s in c and d in c and s != d))}
    assert set(rows(graph.cycle_edges(spark.createDataFrame(sorted(e), "src long, dst long")))) == want and len(want) == 4


def test_ego_graphs_of_many_roots(spark):
    e = {(s, d) for s in range(12) for d in range(12) if (s * 7 + d * 5) % 6 == 0}
    nodes, edges = graph.egos(spark.createDataFrame(sorted(e), "src long, dst long"), spark.createDataFrame([(1,), (4,), (11,)], "id long"), 2)
    for root in (1, 4, 11):
        ids, inner = brute_ego(e, root, 2)
        assert dict(nodes.where(F.col("graph") == root).select("id", "column").collect()) == ids
        assert rows(edges.where(F.col("graph") == root).select("src", "dst")) == sorted(inner)


def test_grid_has_no_window_over_all_rows(spark):
    g = graph.grid(spark.createDataFrame([(1, -1), (2, 0), (3, 2), (4, 2)], "id int, column int"))
    assert rows(g) == [(1, -1, 0.0, 0.0), (2, 0, 240.0, 0.0), (3, 2, 480.0, -40.0), (4, 2, 480.0, 40.0)]
    assert "dense_rank" not in g._jdf.queryExecution().toString()


def test_split_outside_takes_every_text(spark, tmp_path):
    spark.createDataFrame([(1, "a, b"), (2, "c (d, e), f"), (3, "g"), (4, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.QUERIES["split_outside"](spark, str(tmp_path)))
    assert got == [(1, 0, "a"), (1, 1, " b"), (2, 0, "c (d, e)"), (2, 1, " f"), (3, 0, "g")]


def test_closest_equals_trying_all_candidates(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aab\U0001f600cde\u00e9f") for _ in range(rng.randrange(9)))
    candidates, values = {word() for _ in range(150)}, ["xaybzc", "", None, "b", "b", "\nab", *[word() for _ in range(250)]]
    candidates |= {"abc", "", "a\nb"}
    df = match.closest(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(c,) for c in sorted(candidates)], "candidate string"))
    want = [(v, next(iter(difflib.get_close_matches(v, candidates, n=1)), None) if v is not None else None) for v in values]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_suggest_closest_beyond_a_thousand_brands(spark, tmp_path):
    brands = [chr(0x4E00 + k) * 8 for k in range(1500)]
    spark.createDataFrame([(b,) for b in brands], "p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    assert dict(queries.QUERIES["suggest_closest"](spark, str(tmp_path)).collect()) == {b[1:] + "x": b for b in brands}


#: A cycle a-b, c below it, a self-parent s with child k, a root r with children in declared order y, x, and an undeclared parent.
BROKEN = [("a", "b", 0), ("b", "a", 1), ("c", "a", 2), ("s", "s", 3), ("k", "s", 4), ("r", None, 5), ("y", "r", 6), ("x", "r", 7), ("z", "y", 8), ("u", "gone", 9), ("e", "r", 10)]
COUNTS = [("a", 1, 1), ("b", 2, 0), ("c", 4, 1), ("s", 8, 2), ("k", 16, 3), ("y", 32, 4), ("z", 64, 5), ("u", 128, 6), ("new", 256, 7)]


def broken(spark):
    return spark.createDataFrame(BROKEN, "id string, parent string, ord int"), spark.createDataFrame(COUNTS, "id string, direct int, connected int")


def test_outline_of_a_broken_hierarchy(spark):
    got = [(r["id"], r["depth"], r["direct"], r["total"], r["connected"]) for r in graph.outline(*broken(spark)).orderBy("position").collect()]
    assert got == [
        ("r", 0, 0, 96, 9), ("y", 1, 32, 96, 9), ("z", 2, 64, 64, 5), ("x", 1, 0, 0, 0), ("e", 1, 0, 0, 0), ("u", 0, 128, 128, 6),
        ("a", 0, 1, 1, 1), ("b", 0, 2, 2, 0), ("c", 0, 4, 4, 1), ("s", 0, 8, 8, 2), ("k", 0, 16, 16, 3),
    ]


def test_totals_count_no_cycle_twice(spark):
    assert {("a", 1, 1), ("b", 2, 2), ("c", 4, 4), ("r", 0, 96), ("u", 128, 128)} <= set(rows(graph.roll_up(*broken(spark)).select("id", "direct", "total")))


def test_pruned_tree(spark):
    got = rows(graph.pruned(*broken(spark)).select("id", "total"))
    assert got == [("a", 1), ("b", 2), ("c", 4), ("k", 16), ("new", 256), ("r", 96), ("s", 24), ("u", 128), ("y", 96), ("z", 64)]


def test_ancestors_of_a_chain_beyond_a_hundred(spark):
    deep = spark.createDataFrame([(k, k - 1 if k else None) for k in range(105)], "id int, parent int")
    assert graph.ancestors(deep).where("id = 104").count() == 105


def test_links_keep_their_prefix_and_anchor(spark):
    pages = ["A b/c d#e f!", "javascript:alert(1)", "../../x", "", "#only", " /./.. ", "é/ü~*'()", None, "a#"]
    d = spark.createDataFrame([(p,) for p in pages], "p string")
    got = [r[0] for r in d.select(text.safe_url(F.col("p"), "B/")).collect()]
    assert got == ["B/A_b/c_d#e_f!", "B/javascript%3Aalert(1)", "B/x", None, None, None, "B/%C3%A9/%C3%BC~*'()", None, "B/a"]
    said = d.select(*text.source_label(F.concat(F.lit("wiki:"), "p"), "B/")).first()
    assert tuple(said) == ("A b/c d#e f!", "B/A_b/c_d#e_f!")
    assert spark.range(1).select(*text.source_label(F.lit("discord"), "B/")).first()[:] == ("community report", None)


def test_upsert_by_dealt_rows_is_the_same(spark):
    base = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("b", 3, 2), (None, 4, 4)], "id string, v int, _ord int")
    over = spark.createDataFrame([("b", 9, 7), ("c", 8, 8), ("c", 7, 9)], "id string, v int, _ord int")
    want = {("a", 1, 0, 1), ("b", 9, 0, 2), (None, 4, 0, 4), ("c", 7, 1, 8)}
    for parts in (None, 3):
        assert {tuple(r) for r in merge.upsert(base, over, ["id"], parts).select("id", "v", "_new", "_ord").collect()} == want


def test_upsert_replace_has_tasks_in_proportion_to_its_rows(spark, monkeypatch):
    """Shuffle partitions are a fixed number, and a table that grows would grow every task."""
    monkeypatch.setattr(merge, "TASK_ROWS", 100, raising=False)
    n = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    got = queries.QUERIES["upsert_replace"](spark, "/root/testdata/sf0.001")
    assert got.rdd.getNumPartitions() == -(-n // 100)
