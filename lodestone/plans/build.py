"""Plans over whole datasets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import coverage, merge, validate
from ..sources import publish, sinks
from ..sources.files import Dataset
from ..sources.shared import release, written

KEY = ["from", "to", "rel"]
#: Fixed value: the mark of pages that are still being written.
NEW_PAGE = "{{New Content}}"


def merged(derived: Dataset, curated: Dataset) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Generated records with curated ones laid over them: nodes, edges, and suppress rules that match nothing.

    A curated node replaces the fields that it sets, a curated edge the whole edge of its key; suppress
    rules then delete edges of either origin.  Order is ``_new, _ord``.
    """
    fields = [c for c in derived.nodes.columns if c != "id" and not c.startswith("_")]
    nodes = merge.overlay(derived.nodes, curated.nodes, "id", fields)
    edges = merge.upsert(derived.edges.drop("_line", "_set"), curated.edges.drop("_line", "_set"), KEY)
    kept, unmatched = merge.suppress(edges, curated.suppress.select(*KEY, "reason", "_line"), KEY)
    return nodes, kept, unmatched


def build(spark: SparkSession, derived: Dataset, curated: Dataset, root: str, pages: DataFrame | None = None, inventory: DataFrame | None = None, check_only: bool = False) -> dict[str, dict]:
    """Merge, validate, analyse, render: publishes a snapshot of ``nodes, edges, systems, graph, report, problems`` at ``root``.

    Errors are counted while the problems are staged; any of them, and nothing is published (``publish.Refused``, with
    the first errors in its message).  Warnings are published with the rest.  ``check_only`` publishes nothing.
    """
    nodes, edges, unmatched = merged(derived, curated)
    nodes, edges = written(nodes.withColumn("_line", F.lit(None).cast("int"))), written(edges.withColumn("_line", F.lit(None).cast("int")))
    place = lambda df: df.withColumn("_ord", F.struct("_new", "_ord"))
    found = validate.problems(curated.systems, nodes.where("id is not null"), edges, hints=True)
    twice = [repeated_ids(d.nodes) for d in (derived, curated)]
    form = derived.problems.unionByName(curated.problems).select("severity", "message", "line")
    idle = unmatched.select(F.lit("warning").alias("severity"), F.format_string("suppress rule '%s' -> '%s' (%s) matches no edge", "from", "to", "rel").alias("message"), F.col("_line").alias("line"))
    problems = found.unionByName(form).unionByName(idle).unionByName(twice[0]).unionByName(twice[1])
    if pages is not None:
        problems = problems.unionByName(unread(nodes, pages))
    problems = written(problems)

    def checks(counts: dict) -> Iterable[str]:
        n = counts["problems"]["errors"]
        if n:
            first = problems.where("severity = 'error'").orderBy("message", "line").limit(5).collect()
            yield f"{n} error(s), nothing is written: " + "; ".join(r["message"] for r in first)

    systems = curated.systems
    try:
        # what stops a build is staged first, so that a refused one does no more: the report's parts are written as it is planned
        publish.publish(spark, root, {"problems": problems}, checks, {"problems": {"errors": "count_if(severity = 'error')"}}, dry=True)
        tables = {
            "problems": problems, "nodes": nodes, "edges": edges, "systems": systems,
            "graph": sinks.graph_json(place(nodes), place(edges), systems.withColumn("_ord", F.struct(F.lit(0).alias("_new"), F.col("_ord").cast(dict(nodes.dtypes)["_ord"]).alias("_ord")))),
            "report": coverage.report(systems, nodes, edges, inventory, pages),
        }
        return publish.publish(spark, root, tables, checks, {"problems": {"errors": "count_if(severity = 'error')", "warnings": "count_if(severity = 'warning')"}}, dry=check_only)
    finally:
        release(nodes, edges, problems)


def repeated_ids(nodes: DataFrame) -> DataFrame:
    """An error for each id that one file has again."""
    first = nodes.groupBy("id").agg(F.min("_ord").alias("_first"))
    again = nodes.join(first.hint("merge"), "id").where("_ord > _first")
    return again.select(F.lit("error").alias("severity"), F.format_string("duplicate node id '%s' in one file", "id").alias("message"), F.col("_line").alias("line"))


def unread(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Warnings on nodes whose page is not there, or is marked as new while the node claims to be documented."""
    read = nodes.where("trim(wiki) <> ''").select("id", "wiki", "confidence", T.page_file(F.col("wiki")).alias("file"))
    there = pages.select(T.page_file(F.col("page")).alias("file"), F.contains("text", F.lit(NEW_PAGE)).alias("new")).groupBy("file").agg(F.max("new").alias("new"))
    met = read.join(there, "file", "left")
    said = F.when(F.col("new").isNull(), F.format_string("node '%s' names page '%s', which is not there", "id", "wiki"))
    said = F.coalesce(said, F.when(F.col("new") & ~F.coalesce("confidence", F.lit("documented")).isin("provisional", "unknown"), F.format_string("node '%s' is documented, but page '%s' is marked as new", "id", "wiki")))
    return met.select(F.lit("warning").alias("severity"), said.alias("message"), F.lit(None).cast("int").alias("line")).where("message is not null")
