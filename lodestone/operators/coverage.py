"""The coverage report of a dataset, as rows that a text sink writes in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from ..sources.sinks import coverage_lines
from . import graph

#: Headings of the report's sections, by number.
HEADINGS = ["# Coverage report", "## Per-system coverage", "## System hierarchy", "## Unresolved effects", "## Orphan nodes", "## Feedback loops", "## Not swept", "## Known unknowns"]
#: Rows sorted by these stand as in the report.
ORDER = ["section", "part", "path", "rank", "name", "item"]


def report(systems: DataFrame, nodes: DataFrame, edges: DataFrame, inventory: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """The report's lines as rows ``(section, part, path, rank, name, item, value)``; nothing is gathered, the sink sorts them.

    From ``systems(id, name, parent, _ord)``, ``nodes(id, system, wiki, confidence, effects)`` and
    ``edges(from, to, rel)``; ``inventory(system, id)`` lists what should exist and ``pages(page, bytes)``
    what could be read.  Hierarchy and unread pages have a section only where there are any, the
    inventory where one is given; other empty sections say ``None.``  A loop's members stand one a
    line, as continued lines of one list item, so a loop of any size is whole.
    """
    spark = nodes.sparkSession
    # files are far smaller than their rows, and a broadcast would be planned by the files
    large = nodes.hint("merge")
    # several sections read these: they are worked out once
    e = written(graph.valid_edges(edges.select(F.col("from").alias("src"), F.col("to").alias("dst")), large).distinct())
    ends = e.select(F.col("src").alias("id")).union(e.select("dst")).distinct().withColumn("_linked", F.lit(1))
    seen = written(large.select("id", "system").join(ends, "id", "left"))

    def lines(df: DataFrame, section: int, value: Column, path: str | None = None, rank: str = "0", name: str = "''", item: str = "''") -> DataFrame:
        at = F.col(path) if path else F.array().cast("array<bigint>")
        return df.select(F.lit(section).alias("section"), F.lit(1).alias("part"), at.alias("path"), F.expr(rank).cast("long").alias("rank"), F.expr(name).alias("name"), F.expr(item).alias("item"), value.alias("value"))

    code = lambda c: F.format_string("- `%s`", c)
    counts = nodes.agg(F.count("*").alias("n"), F.count_if(F.col("confidence") == "unknown").alias("stubs")).crossJoin(edges.agg(F.count("*").alias("e")))  # one row each
    summary = counts.select(F.posexplode(F.array(F.format_string("- Nodes: %d", "n"), F.format_string("- Edges: %d", "e"), F.format_string("- Stubs (confidence `unknown`): %d", "stubs"))).alias("k", "line"))
    shares = coverage_lines(seen.groupBy("system").agg(F.count("_linked").alias("covered"), F.count("*").alias("total")))

    per_system = seen.groupBy(F.col("system").alias("id")).agg(F.count("*").alias("direct"), F.count("_linked").alias("connected"))
    tree = graph.outline(systems.select("id", "parent", F.col("_ord").alias("ord")), per_system).join(systems.select("id", "name"), "id")
    own = F.when(F.col("direct") != F.col("total"), F.format_string(" (%d directly)", "direct")).otherwise("")
    said = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.format_string("- **%s** — %d nodes, %d connected", "name", "total", "connected"), own)

    pointing = edges.where("rel <> 'requires'").select(F.col("from").alias("id"))
    loops = written(graph.strong_components(e))
    loops = loops.join(loops.groupBy("component").count(), "component")
    member = F.when(F.col("id") == F.col("component"), code("id")).otherwise(F.format_string("  → `%s`", "id"))

    parts = [
        lines(summary, 0, F.col("line"), rank="k"),
        lines(shares, 1, F.col("value"), name="system"),
        lines(tree.withColumn("path", F.array("position")), 2, said, path="path", name="id"),
        lines(large.where(F.size("effects") > 0).join(pointing, "id", "left_anti"), 3, code("id"), name="id"),
        lines(seen.where("_linked is null"), 4, code("id"), name="id"),
        lines(loops, 5, member, rank="-count", name="component", item="id"),
    ]
    if pages is not None:
        read = nodes.where("wiki is not null").select(F.substring_index("wiki", "#", 1).alias("page"))
        parts.append(lines(pages.join(read, "page", "left_anti"), 6, F.format_string("| `%s` | %d |", "page", "bytes"), rank="-bytes", name="page"))
    if inventory is not None:
        absent = inventory.join(nodes.select("id"), "id", "left_anti")
        parts += [lines(absent, 7, code("id"), name="system", item="id"), lines(absent.select("system").distinct(), 7, F.format_string("### %s", "system"), name="system")]
    body = parts[0]
    for p in parts[1:]:
        body = body.unionByName(p)
    body = written(body)  # asked twice which sections it has

    tables = {1: ["| System | Connected | Total | Coverage |", "|---|---|---|---|"], 6: ["| Page | Bytes |", "|---|---|"]}
    heads = [(s, 0, [], k, "", "", line) for s, h in enumerate(HEADINGS) if s != 7 or inventory is not None for k, line in enumerate([h, "", *tables.get(s, [])])]
    heads = spark.createDataFrame(heads, body.schema)
    empty = spark.createDataFrame([(s, 1, [], 0, "", "", "None.") for s in (3, 4, 5, *((7,) if inventory is not None else ()))], body.schema)
    present = body.select("section").distinct()
    always = heads.where("section not in (2, 6)").unionByName(heads.join(present.where("section in (2, 6)"), "section", "left_semi").select(*body.columns))
    return body.unionByName(always).unionByName(empty.join(present, "section", "left_anti").select(*body.columns))


def write_report(rows: DataFrame, path: str) -> None:
    """The report as text parts which, read in order of name, are one Markdown document."""
    rows.orderBy(*ORDER).select("value").write.mode("overwrite").text(path)
