"""The validator, the coverage report and an extraction's warnings on small datasets."""

import pytest

from lodestone.operators import coverage, graph, validate, wikitext

SYSTEMS = "id string, name string, parent string, _line int, _ord int"
NODES = "id string, system string, wiki string, confidence string, effects array<string>, _line int, _ord int"
EDGES = "`from` string, `to` string, rel string, targets_effect int, _line int"


def dataset(spark, systems, nodes, edges):
    return spark.createDataFrame(systems, SYSTEMS), spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES)


def small(spark):
    systems = [("b", "Beta", "a", 1, 0), ("a", "Alpha", None, 2, 1), ("x", "Ex", "y", 3, 2), ("y", "Why", "x", 4, 3)]
    nodes = [("n1", "a", "P#top", "unknown", ["e"], 1, 0), ("n2", "b", "Q", None, ["e"], 2, 1), ("n3", "b", None, None, [], 3, 2), ("n4", "x", None, None, None, 4, 3)]
    edges = [("n1", "n2", "boosts", None, 1), ("n2", "n1", "requires", None, 2), ("n2", "gone", "requires", 0, 3)]
    return dataset(spark, systems, nodes, edges)


def text(rows):
    return [r["value"] for r in rows.orderBy(*coverage.ORDER).collect()]


def test_report_in_order(spark):
    inventory = spark.createDataFrame([("a", "n1"), ("a", "n9"), ("a", "n8")], "system string, id string")
    pages = spark.createDataFrame([("P", 5), ("R", 7), ("S", 9), ("T", 9)], "page string, bytes long")
    assert text(coverage.report(*small(spark), inventory, pages)) == [
        "# Coverage report", "", "- Nodes: 4", "- Edges: 3", "- Stubs (confidence `unknown`): 1",
        "## Per-system coverage", "", "| System | Connected | Total | Coverage |", "|---|---|---|---|", "| a | 1 | 1 | 100% |", "| b | 1 | 2 | 50% |", "| x | 0 | 1 | 0% |",
        "## System hierarchy", "", "- **Alpha** — 3 nodes, 2 connected (1 directly)", "  - **Beta** — 2 nodes, 1 connected", "- **Ex** — 1 nodes, 0 connected", "- **Why** — 0 nodes, 0 connected",
        "## Unresolved effects", "", "- `n2`",
        "## Orphan nodes", "", "- `n3`", "- `n4`",
        "## Feedback loops", "", "- `n1`", "  → `n2`",
        "## Not swept", "", "| Page | Bytes |", "|---|---|", "| `S` | 9 |", "| `T` | 9 |", "| `R` | 7 |",
        "## Known unknowns", "", "### a", "- `n8`", "- `n9`",
    ]


def test_report_of_nothing(spark):
    assert text(coverage.report(*dataset(spark, [], [], []))) == [
        "# Coverage report", "", "- Nodes: 0", "- Edges: 0", "- Stubs (confidence `unknown`): 0",
        "## Per-system coverage", "", "| System | Connected | Total | Coverage |", "|---|---|---|---|",
        "## Unresolved effects", "", "None.", "## Orphan nodes", "", "None.", "## Feedback loops", "", "None.",
    ]


def test_report_file(spark, tmp_path):
    coverage.write_report(coverage.report(*small(spark)), str(tmp_path / "report"))
    written = [x for p in sorted((tmp_path / "report").glob("part-*")) for x in p.read_text().splitlines()]
    assert written == text(coverage.report(*small(spark)))


def test_problems(spark):
    systems = [("relics", "R", None, 1, 0), ("relics", "R", "stats", 5, 1), ("stats", "S", "relic", 2, 2), ("p", "P", "p", 3, 3)]
    nodes = [("anvil", "relics", None, None, ["e"], 1, 0), ("anvil", "stat", None, None, ["e", "e"], 2, 1)]
    edges = [("anvil", "anvil", "boosts", 2, 7), ("anvils", "anvil", "boosts", 1, 8), ("anvil", "zzz", "boosts", -1, 9)]
    found = validate.problems(*dataset(spark, systems, nodes, edges), hints=True)
    errors, others = validate.errors_and_warnings(found)
    assert others.isEmpty()
    assert sorted((r["line"], r["message"]) for r in errors.collect()) == [
        (2, "duplicate node id 'anvil'"), (2, "node 'anvil' has undeclared system 'stat'; did you mean 'stats'?"),
        (2, "system 'stats' has unknown parent 'relic'; did you mean 'relics'?"), (3, "system 'p' is in a parent cycle"), (5, "duplicate system id 'relics'"),
        (7, "edge to 'anvil' points at effect 2 of 2"), (7, "self-edge on 'anvil'"), (8, "unknown node 'anvils' in 'from'; did you mean 'anvil'?"), (9, "unknown node 'zzz' in 'to'"),
    ]


def test_no_systems_declare_nothing(spark):
    assert validate.problems(*dataset(spark, [], [("a", "s", None, None, None, 1, 0)], [])).isEmpty()


def test_ego_of_an_unknown_root_fails(spark):
    e = spark.createDataFrame([("a", "b")], "src string, dst string")
    known = spark.createDataFrame([("a",), ("b",), ("alone",)], "id string")
    root = lambda x: spark.createDataFrame([(x,)], "id string")
    assert [tuple(r) for r in graph.ego(e, root("alone"), 2, known)[0].collect()] == [("alone", 0)]
    with pytest.raises(Exception, match="no such node: c"):
        graph.ego(e, root("c"), 2, known)[0].collect()


def test_card_names_that_clash_are_told(spark):
    pages = spark.createDataFrame([("Tarot", "{{Tarot Cards|card_name=Anvil|effect=x\n}}\n{{Tarot Cards|card_name=Sun|effect=y\n}}")], "page string, text string")
    vocab = spark.createDataFrame([("anvil", "relic-1")], "surface string, target string")
    clash = wikitext.parse_cards(pages, vocab)[2]
    assert [tuple(r) for r in clash.collect()] == [("Anvil", "tarot-anvil")]


def test_sections_share_what_they_read(spark, capsys):
    """Links, loops and the hierarchy are worked out once, not again wherever a section or a heading asks for them."""
    coverage.report(*small(spark)).explain()
    plan = capsys.readouterr().out
    assert "_linked" not in plan and "SortMergeJoin" not in plan


def test_pages_are_parsed_a_few_at_a_time():
    import pandas as pd

    parts = list(wikitext.slices([pd.DataFrame({"page": range(250)}), pd.DataFrame({"page": []})]))
    assert [len(p) for p in parts] == [100, 100, 50] and list(pd.concat(parts)["page"]) == list(range(250))
