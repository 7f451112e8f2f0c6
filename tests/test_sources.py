import json
import os

import pytest

from lodestone.operators import references, wikitext
from lodestone.plans import build
from lodestone.sources import files, sinks

DATA = """systems:
- {id: s, name: S}
nodes:
- {id: a, name: Gold, system: s, kind: stat, aliases: [GD]}
- {id: b, name: B, system: s, kind: odd, colour: red}
edges:
- {from: a, to: b, rel: boosts, source: x}
"""


def test_dataset_lines_set_fields_and_problems(spark, tmp_path):
    (tmp_path / "d.yaml").write_text(DATA)
    d = files.load_dataset(spark, str(tmp_path / "d.yaml"))
    assert [(r["id"], r["_line"], "aliases" in r["_set"]) for r in d.nodes.orderBy("_ord").collect()] == [("a", 4, True), ("b", 5, False)]
    assert d.suppress.count() == 0
    said = sorted(r["message"] for r in d.problems.collect())
    assert [m.split(":")[0] for m in said] == ["nodes.1.colour", "nodes.1.kind"]


def test_empty_broken_and_tagged_files(spark, tmp_path):
    for name, text in (("a", ""), ("b", "- 1"), ("c", "nodes: !!python/object/apply:os.getcwd []")):
        (tmp_path / f"{name}.yaml").write_text(text)
    d = files.load_dataset(spark, str(tmp_path))
    assert d.nodes.count() == 0
    assert sorted(os.path.basename(r["path"]) for r in d.problems.collect()) == ["b.yaml", "c.yaml"]


def test_api_pages_last_title_wins(spark, tmp_path):
    page = lambda title, text: {"title": title, "revisions": [{"slots": {"main": {"*": text}}}]}
    (tmp_path / "1.json").write_text(json.dumps({"query": {"pages": {"1": page("A", "old"), "2": {"title": "B"}}}}))
    (tmp_path / "2.json").write_text(json.dumps({"query": {"pages": {"1": page("A", "new")}}}))
    assert [tuple(r) for r in files.api_pages(spark, str(tmp_path)).collect()] == [("A", "new")]
    (tmp_path / "3.json").write_text(json.dumps({"error": {"code": "x"}}))
    with pytest.raises(Exception, match="API error x"):
        files.api_pages(spark, str(tmp_path)).collect()


def test_records_and_graph_round_trip(spark, tmp_path):
    (tmp_path / "d.yaml").write_text(DATA.replace("odd, colour: red", "stat"))
    d = files.load_dataset(spark, str(tmp_path / "d.yaml"))
    sinks.write_records(d.nodes, d.edges, str(tmp_path / "out"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))) + "\n"
    (tmp_path / "again.yaml").write_text(text)
    again = files.load_dataset(spark, str(tmp_path / "again.yaml"))
    assert [r["id"] for r in again.nodes.orderBy("_ord").collect()] == ["a", "b"] and again.edges.count() == 1
    sinks.write_graph(d.nodes, d.edges, d.systems, str(tmp_path / "graph"))
    whole = json.loads("".join(p.read_text() for p in sorted((tmp_path / "graph").glob("part-*"))))
    assert whole["version"] == 1 and [list(n) for n in whole["nodes"]] == [["aliases", "id", "kind", "name", "system"], ["id", "kind", "name", "system"]]


def test_tables_carry_rows_down_and_skip_odd_rows():
    text = '{|\n|+ Cap\n! A !! B\n|-\n| rowspan="2" | x || 1\n|-\n| 2\n|-\n| y\n|-\n! colspan=2 | mid\n|-\n| [[p|q]] || {{k|a||b}}\n|}'
    rows = [(r[2].strip(), [c.strip() for c in r[4]]) for r in wikitext.table_rows(text)]
    assert rows == [("Cap", ["x", "1"]), ("Cap", ["x", "2"]), ("Cap", ["[[p|q]]", "{{k|a||b}}"])]


def test_template_instances_balance_braces():
    assert wikitext.instances("{{Rec|a={{x|y}}}} {{recs|z}} {{rec |b=1}} {{rec|open", "rec") == ["|a={{x|y}}", " |b=1"]
    assert wikitext.named_fields("7| A  b = x=y |[[c|d]]| a b=2") == {"a b": "2"}


def test_references_inputs_pointers_and_claims(spark):
    d = spark.createDataFrame([(1, "Relics 1, 2 and 3's second effect"), (2, "Boosts Gold (based on Gems) and Fire Node 3"), (3, "King of Cups' gold"), (4, None)], "k int, t string")
    words = spark.createDataFrame([("King", "k"), ("Gold", "g"), ("Gems", "m")], "surface string, target string")
    got = {r["k"]: [tuple(x) for x in r["refs"]] for r in references.referenced(d, words, "t").collect()}
    assert got[1] == [("relic-1", 1, False, False), ("relic-2", 1, False, False), ("relic-3", 1, False, False)]
    assert got[2] == [("g", None, True, False), ("m", None, True, True), ("fire-node-3", None, False, False)]
    assert got[3] == [("tarot-king-of-cups", None, False, False), ("g", None, True, False)] and got[4] == []


@pytest.mark.skipif("LODESTONE_CORPUS" not in os.environ, reason="needs a corpus of pages, curated and derived records")
def test_extraction_equals_derived_records(spark):
    at = os.environ["LODESTONE_CORPUS"]
    curated, derived = (files.load_dataset(spark, f"{at}/{k}.yaml") for k in ("relationships", "derived"))
    nodes, edges, dropped = wikitext.extract(files.raw_pages(spark, f"{at}/raw"), files.load_manifest(spark, f"{at}/sweep.yaml"), curated.nodes)
    nodes, edges = sinks.distinct_records(nodes, edges)
    listed = lambda df, columns: [str(r[:-1]) for r in df.select(*columns, "_ord").orderBy("_ord").collect()]
    assert listed(nodes, wikitext.NODE[:-1]) == listed(derived.nodes, wikitext.NODE[:-1])
    assert listed(edges, wikitext.EDGE[:-1]) == listed(derived.edges, wikitext.EDGE[:-1])
    assert dropped.isEmpty()


def test_merged_overlays_replaces_and_suppresses(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("nodes:\n- {id: a, name: A, system: s, kind: stat, wiki: W}\n- {id: b, name: B, system: s, kind: stat}\nedges:\n- {from: a, to: b, rel: boosts, source: x, note: old}\n- {from: b, to: a, rel: boosts, source: x}\n")
    (tmp_path / "c.yaml").write_text("nodes:\n- {id: a, name: AA, system: s, kind: stat}\n- {id: c, name: C, system: s, kind: stat}\nedges:\n- {from: a, to: b, rel: boosts, source: y}\nsuppress:\n- {from: b, to: a, rel: boosts, reason: wrong}\n- {from: c, to: a, rel: boosts, reason: none}\n")
    nodes, edges, unmatched = build.merged(*(files.load_dataset(spark, str(tmp_path / f"{k}.yaml")) for k in "dc"))
    assert [(r["id"], r["name"], r["wiki"]) for r in nodes.orderBy("_new", "_ord").collect()] == [("a", "AA", "W"), ("b", "B", None), ("c", "C", None)]
    assert [(r["from"], r["to"], r["source"], r["note"]) for r in edges.collect()] == [("a", "b", "y", None)]
    assert [r["from"] for r in unmatched.collect()] == ["c"]


@pytest.mark.skipif("LODESTONE_CORPUS" not in os.environ, reason="needs a corpus of pages, curated and derived records")
def test_merged_counts_of_the_corpus(spark):
    at = os.environ["LODESTONE_CORPUS"]
    nodes, edges, unmatched = build.merged(*(files.load_dataset(spark, f"{at}/{k}.yaml") for k in ("derived", "relationships")))
    assert (nodes.count(), edges.count(), unmatched.count()) == (943, 1528, 0)


def test_record_files_are_parsed_once_for_all_rules(spark, tmp_path, capsys):
    (tmp_path / "d.yaml").write_text("nodes:\n- id: a\n  name: A\n  system: s\n  kind: odd\n  colour: red\n- name: B\n")
    d = files.load_dataset(spark, str(tmp_path / "d.yaml"))
    want = ["nodes.0.colour: unknown field", "nodes.0.kind: not one of relic, stat, tree-node, currency, tarot-card, upgrade, group", *(f"nodes.1.{f}: missing" for f in ("id", "kind", "system"))]
    assert sorted(r["message"] for r in d.problems.collect()) == want
    d.problems.explain()
    assert "InPandas" not in capsys.readouterr().out


def test_faults_are_worded_by_the_plain_loader():
    assert [r[-1] for r in files._records("nodes: [", ["nodes"])] == ["while parsing a flow node"] and list(files._records("", ["nodes"])) == []
