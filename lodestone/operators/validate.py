"""Rules that a merged dataset must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from .graph import parent_cycles
from .match import closest
from .merge import last_wins


def problems(systems: DataFrame, nodes: DataFrame, edges: DataFrame, hints: bool = False) -> DataFrame:
    """One row for each broken rule: ``severity, message, line``.

    From ``systems(id, parent, _line, _ord)``, ``nodes(id, system, effects, _line, _ord)`` and
    ``edges(from, to, targets_effect, _line)``.  Where ids repeat, each occurrence after the first is a
    problem and the last one's parent and effects count.  ``hints`` adds the nearest known name to
    messages on unknown names: these are written first, and no name is compared where there are none.

    Nodes are met by merge joins: a stored table's files, from which Spark estimates what a broadcast would
    take, are many times smaller than its rows.
    """
    system_ids, node_ids = systems.select("id").distinct(), nodes.select("id").distinct().hint("merge")

    def found(df: DataFrame, message: Column, unknown: str | None = None, of: DataFrame | None = None) -> DataFrame:
        value = F.col(unknown) if unknown else F.lit(None)
        out = df.select(F.lit("error").alias("severity"), message.alias("message"), F.col("_line").alias("line"), value.cast("string").alias("value"))
        if not hints or of is None:
            return out.drop("value")
        out = written(out, count=F.col("value").isNotNull())
        if not out.counted:
            return out.drop("value")
        near = closest(out.where("value is not null").select("value").distinct(), of.select(F.col("id").alias("candidate")))
        said = F.when(F.col("suggestion").isNotNull(), F.format_string("; did you mean '%s'?", "suggestion")).otherwise("")
        return out.join(near, "value", "left").select("severity", F.concat("message", said).alias("message"), "line")

    def repeated(df: DataFrame, what: str) -> DataFrame:
        first = df.groupBy("id").agg(F.min("_ord").alias("_first"))
        return found(df.join(first.hint("merge"), "id").where("_ord > _first"), F.format_string(f"duplicate {what} id '%s'", "id"))

    lost = parent_cycles(last_wins(systems, ["id"], ["_ord"]).select("id", "parent"))
    parent_of = systems.where("parent is not null").join(system_ids.withColumnRenamed("id", "parent"), "parent", "left_anti")
    # only where any system is declared at all
    some = systems.limit(1).select(F.lit(True).alias("_some"))
    stray = nodes.join(system_ids.withColumnRenamed("id", "system"), "system", "left_anti").withColumn("_some", F.lit(True)).join(some, "_some", "left_semi")
    ends = [found(edges.join(node_ids.withColumnRenamed("id", end), end, "left_anti"), F.format_string(f"unknown node '%s' in '{end}'", end), end, node_ids) for end in ("from", "to")]
    sizes = last_wins(nodes.select(F.col("id").alias("to"), F.coalesce(F.size("effects"), F.lit(0)).alias("_n"), "_ord"), ["to"], ["_ord"]).select("to", "_n")
    pointers = edges.where("targets_effect is not null").join(sizes.hint("merge"), "to").where("targets_effect < 0 or targets_effect >= _n")
    parts = [
        repeated(systems, "system"),
        found(parent_of, F.format_string("system '%s' has unknown parent '%s'", "id", "parent"), "parent", system_ids),
        found(systems.join(lost, "id", "left_semi"), F.format_string("system '%s' is in a parent cycle", "id")),
        found(stray, F.format_string("node '%s' has undeclared system '%s'", "id", "system"), "system", system_ids),
        repeated(nodes, "node"),
        *ends,
        found(edges.where(F.col("from") == F.col("to")), F.format_string("self-edge on '%s'", "from")),
        found(pointers, F.format_string("edge to '%s' points at effect %d of %d", "to", "targets_effect", "_n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def errors_and_warnings(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Problems by severity: those that stop a build, and those that don't."""
    return found.where("severity = 'error'"), found.where("severity <> 'error'")
