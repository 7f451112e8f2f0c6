"""The paginated source against a server of its own, snapshots that are whole or absent, the gated build."""

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodestone.plans import build
from lodestone.sources import api, files, publish


def page(title, *texts):
    return {"title": title, "revisions": [{"slots": {"main": {"*": t}}} for t in texts]}


def answers(*payloads):
    """A transport that gives the payloads in turn and notes what it was asked."""
    asked, rest = [], list(payloads)

    def get(parameters):
        asked.append(parameters)
        return rest.pop(0)

    return get, asked


def test_a_chain_follows_its_tokens():
    get, asked = answers({"query": {"pages": {"1": page("A", "a", "old"), "2": page("B")}}, "continue": {"gapcontinue": "C", "continue": "x"}}, {"query": {"pages": {"3": page("C", ""), "4": {"title": "D", "revisions": [{"slots": {}}]}}}})
    assert list(api.chain(get, {"gapnamespace": 4})) == [("A", "a", 0, 0), ("C", "", 1, 0)]
    assert "gapcontinue" not in asked[0] and asked[1]["gapcontinue"] == "C" and asked[1]["gapnamespace"] == 4 and asked[1]["gaplimit"] == 50


@pytest.mark.parametrize("error,said", [({"code": "maxlag", "info": "slow"}, r"\[maxlag\]: slow"), ("down", r"\[unknown\]: down"), ({}, r"\[unknown\]")])
def test_errors_with_a_good_status_are_errors(error, said):
    with pytest.raises(api.ApiError, match=said):
        list(api.chain(answers({"error": error})[0], {}))


def test_a_token_that_never_advances_is_an_error():
    stuck = {"query": {"pages": {}}, "continue": {"gapcontinue": "A"}}
    with pytest.raises(api.ApiError, match="after 200 requests"):
        list(api.chain(lambda p: stuck, {}))
    get, asked = answers(*[stuck] * 199, {"query": {"pages": {"1": page("Z", "z")}}})
    assert list(api.chain(get, {})) == [("Z", "z", 199, 0)] and len(asked) == 200


class Service(BaseHTTPRequestHandler):
    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        self.server.seen.append((q, self.headers["User-Agent"]))
        status = 503 if q["gapnamespace"] == "9" else 200
        more = {"continue": {"gapcontinue": "2"}} if "gapcontinue" not in q else {}
        n = f"{q['gapnamespace']}-{q.get('gapcontinue', '1')}"
        body = json.dumps({"query": {"pages": {"1": page(f"T{n}", f"text {n}"), "2": page("Twice", n)}}, **more}).encode()
        self.send_response(status)
        self.end_headers()
        self.wfile.write(body if q["gapnamespace"] != "8" else b"<html>")

    def log_message(self, *a):
        pass


def test_the_source_reads_a_service(spark):
    server = HTTPServer(("127.0.0.1", 0), Service)
    server.seen = []
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}/api"
    try:
        got = {r["title"]: r["text"] for r in api.fetched_pages(spark, url=at, agent="tester", starts=json.dumps([{"gapnamespace": 0}, {"gapnamespace": 4}])).collect()}
        assert got == {"T0-1": "text 0-1", "T0-2": "text 0-2", "T4-1": "text 4-1", "T4-2": "text 4-2", "Twice": "4-2"}
        assert {a for _, a in server.seen} == {"tester"}
        for start, said in ((9, "answered 503"), (8, "no JSON")):
            with pytest.raises(PySparkException, match=said):
                api.fetched_pages(spark, url=at, starts=json.dumps([{"gapnamespace": start}])).collect()
    finally:
        server.shutdown()
    with pytest.raises(PySparkException, match="cannot be reached"):
        api.fetched_pages(spark, url=at, timeout="2").collect()
    with pytest.raises(PySparkException, match="either a url or"):
        api.fetched_pages(spark).collect()


def test_saved_responses_are_read_on_and_a_missing_one_is_an_error(spark, tmp_path):
    says = lambda k, more: json.dumps({"query": {"pages": {"1": page(f"P{k}", "x")}}, **({"continue": {"gapcontinue": more}} if more else {})})
    rows = [(0, 0, "", says(0, "1")), (0, 1, "1", says(1, None)), (1, 0, "", says(2, "7"))]
    at = f"file://{tmp_path}/r"
    api.save_responses(spark.createDataFrame(rows, "start int, request int, token string, payload string"), at)
    assert sorted(r["title"] for r in api.fetched_pages(spark, saved=at).collect()) == ["P0", "P1"]
    with pytest.raises(PySparkException, match="no response to '7'"):
        api.fetched_pages(spark, saved=at, starts="[{}, {}]").collect()


# --- snapshots ------------------------------------------------------------------------------------


def listed(root):
    return sorted(os.listdir(root)) if os.path.exists(root) else []


def test_a_failing_write_leaves_the_old_snapshot(spark, tmp_path):
    root = str(tmp_path / "s")
    assert publish.current(spark, root, "a") is None and publish.version(spark, root) is None
    counts = publish.publish(spark, root, {"a": spark.range(3), "b": spark.range(2)}, measures={"a": {"top": "max(id)"}})
    assert counts["a"] == {"rows": 3, "top": 2} and counts["b"] == {"rows": 2}
    reader, before = publish.current(spark, root, "a"), listed(root)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException, match="boom"):
        publish.publish(spark, root, {"a": spark.range(9), "b": broken})
    assert listed(root) == before and publish.current(spark, root, "a").count() == 3
    with pytest.raises(publish.Refused, match="too few"):
        publish.publish(spark, root, {"a": spark.range(1)}, lambda c: ["too few"] if c["a"]["rows"] < 2 else [])
    assert publish.publish(spark, root, {"a": spark.range(7)}, dry=True)["a"]["rows"] == 7
    assert listed(root) == before
    # a reader of the version before finishes; the one before that goes
    publish.publish(spark, root, {"a": spark.range(4)})
    assert reader.count() == 3 and publish.current(spark, root, "a").count() == 4 and publish.current(spark, root, "b") is None
    publish.publish(spark, root, {"a": spark.range(5)})
    assert len([v for v in listed(root) if v.startswith("version-")]) == 2


def test_another_writer_in_between_is_noticed(spark, tmp_path):
    root = str(tmp_path / "s")

    def meanwhile(counts):
        if counts["a"]["rows"] == 1:
            publish.publish(spark, root, {"a": spark.range(2)})
        return []

    with pytest.raises(publish.Refused, match="another writer"):
        publish.publish(spark, root, {"a": spark.range(1)}, meanwhile)
    assert publish.current(spark, root, "a").count() == 2


def test_pages_replace_reap_and_refuse(spark, tmp_path):
    root = str(tmp_path / "p")
    pages = spark.createDataFrame([(f"P {k}", "x") for k in range(10)], "title string, text string")
    assert publish.publish_pages(spark, pages, root).count() == 0
    with pytest.raises(publish.Refused, match="shrinks from 10 to 7"):
        publish.publish_pages(spark, pages.where("title < 'P 7'"), root)
    with pytest.raises(publish.Refused, match="no file name"):
        publish.publish_pages(spark, pages.unionByName(spark.createDataFrame([("a\0b", "x")], "title string, text string")), root)
    with pytest.raises(publish.Refused, match="no pages"):
        publish.publish_pages(spark, pages.where("false"), str(tmp_path / "q"))
    assert publish.current(spark, root, "pages").count() == 10
    # exactly the floor passes
    stale = publish.publish_pages(spark, pages.where("title < 'P 8'"), root)
    assert [r[0] for r in stale.orderBy("file").collect()] == ["P_8.wikitext", "P_9.wikitext"] and publish.current(spark, root, "pages").count() == 8


# --- the build ------------------------------------------------------------------------------------

DERIVED = "nodes:\n- {id: a, name: A, system: s, kind: stat, wiki: Home}\n- {id: b, name: B, system: s, kind: stat}\nedges:\n- {from: a, to: b, rel: boosts, source: x}\n"
CURATED = "systems:\n- {id: s, name: S}\nnodes:\n- {id: c, name: C, system: s, kind: stat}\nedges:\n- {from: c, to: a, rel: boosts, source: y}\nsuppress:\n- {from: c, to: b, rel: boosts, reason: none}\n"


def built(spark, tmp_path, derived, curated, **more):
    for k, text in (("d", derived), ("c", curated)):
        (tmp_path / f"{k}.yaml").write_text(text)
    pages = spark.createDataFrame([("Home", "{{New Content}} x", 10), ("Other", "y", 20)], "page string, text string, bytes long")
    return build.build(spark, *(files.load_dataset(spark, str(tmp_path / f"{k}.yaml")) for k in "dc"), str(tmp_path / "out"), pages=pages, **more)


def test_a_build_publishes_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    assert built(spark, tmp_path, DERIVED, CURATED, check_only=True)["problems"]["errors"] == 0 and publish.version(spark, root) is None
    counts = built(spark, tmp_path, DERIVED, CURATED)
    assert (counts["nodes"]["rows"], counts["edges"]["rows"], counts["problems"]["warnings"], counts["graph"]["rows"]) == (3, 2, 2, 6)
    said = {r["message"] for r in publish.current(spark, root, "problems").collect()}
    assert said == {"node 'a' is documented, but page 'Home' is marked as new", "suppress rule 'c' -> 'b' (boosts) matches no edge"}
    report = [r["value"] for r in publish.current(spark, root, "report").orderBy("section", "part", "path", "rank", "name", "item").collect()]
    assert "- Nodes: 3" in report and "| `Other` | 20 |" in report
    faults = {
        "unknown node 'zz' in 'to'": (DERIVED.replace("to: b", "to: zz"), CURATED),
        "undeclared system 't'": (DERIVED, CURATED.replace("name: C, system: s", "name: C, system: t")),
        "duplicate node id 'b' in one file": (DERIVED.replace("edges:", "- {id: b, name: B2, system: s, kind: stat}\nedges:"), CURATED),
        "kind: not one of": (DERIVED, CURATED.replace("kind: stat", "kind: star")),
    }
    for reason, (d, c) in faults.items():
        with pytest.raises(publish.Refused, match=reason):
            built(spark, tmp_path, d, c)
    assert publish.current(spark, root, "nodes").count() == 3 and len(listed(root)) == len([n for n in listed(root) if n.startswith(("version-", ".", "_current"))])


def broadcasts(spark, since):
    """Rows of each broadcast in the final plans of executions from number ``since`` on."""
    store = spark._jsparkSession.sharedState().statusStore()
    items = lambda seq: [seq.apply(i) for i in range(seq.size())]
    for x in items(store.executionsList())[since:]:
        values = store.executionMetrics(x.executionId())
        for node in items(store.planGraph(x.executionId()).allNodes()):
            if node.name() == "BroadcastExchange":
                said = [values.get(m.accumulatorId()) for m in items(node.metrics()) if m.name() == "number of output rows"]
                yield from (int(v.get().replace(",", "")) for v in said if v.isDefined())


def test_a_build_broadcasts_no_nodes(spark):
    """Files of nodes, a few bytes a row, are below the limit of a broadcast where their rows are many times above it."""
    from lodestone.service_queries import build_published

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    since = spark._jsparkSession.sharedState().statusStore().executionsList().size()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        nodes = build_published(spark, "/root/testdata/sf0.01").where("what = 'node'").count()
        rows = list(broadcasts(spark, since))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert nodes == 2100 and rows and max(rows) < nodes / 2
