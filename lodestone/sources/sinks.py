"""Sinks: record files, graph documents, coverage lines; ``publish`` replaces whole snapshots."""

from __future__ import annotations

import pandas as pd
import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import first_wins

def filled(df: DataFrame, drop: tuple[str, ...] = ()) -> Column:
    """Each row as JSON with sorted keys, without nulls and empty lists."""
    kind = dict(df.dtypes)
    field = lambda c: F.when(F.size(c) > 0, F.col(c)) if kind[c].startswith("array") else F.col(f"`{c}`")
    return F.to_json(F.struct(*[field(c).alias(c) for c in sorted(df.columns) if not c.startswith("_") and c not in drop]))


def distinct_records(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes, the first of each id, and edges, the first of each whole payload."""
    payload = [c for c in edges.columns if not c.startswith("_")]
    return first_wins(nodes, ["id"], ["_ord"]), first_wins(edges, payload, ["_ord"])


def yaml_lines(df: DataFrame, section: int) -> DataFrame:
    """Records as YAML list items: ``_section, _ord, value``; write them sorted by section and position."""

    @F.pandas_udf("string")
    def item(s: pd.Series) -> pd.Series:
        return s.map(lambda t: yaml.safe_dump([yaml.safe_load(t)], sort_keys=False, allow_unicode=True, width=100).rstrip("\n"))

    return df.select(F.lit(section).alias("_section"), F.col("_ord"), item(filled(df)).alias("value"))


def write_records(nodes: DataFrame, edges: DataFrame, path: str, header: str = "") -> None:
    """A record file as a folder of text parts which, read in order of name, are one YAML document."""
    nodes, edges = distinct_records(nodes, edges)
    spark = nodes.sparkSession
    kind = dict(nodes.dtypes)["_ord"]
    heads = spark.createDataFrame([(0, f"{header}nodes:"), (2, "edges:")], "_section int, value string").select("_section", F.lit(None).cast(kind).alias("_ord"), "value")
    lines = heads.unionByName(yaml_lines(nodes, 1)).unionByName(yaml_lines(edges, 3))
    lines.orderBy("_section", "_ord").select("value").write.mode("overwrite").text(path)


def graph_json(nodes: DataFrame, edges: DataFrame, systems: DataFrame) -> DataFrame:
    """A graph document as ordered lines ``(_section, _ord, value)``; systems are left out where there are none."""
    out = None
    for k, df in enumerate((nodes, edges, systems)):
        part = df.select(F.lit(k).alias("_section"), "_ord", filled(df).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def write_graph(nodes: DataFrame, edges: DataFrame, systems: DataFrame, path: str) -> None:
    """A graph document (version 1) as text parts; each record is one line, so no list is gathered anywhere."""
    spark, lines = nodes.sparkSession, graph_json(nodes, edges, systems)
    first = lines.groupBy("_section").agg(F.min("_ord").alias("_first"))
    lines = lines.join(F.broadcast(first), "_section").select(F.col("_section"), "_ord", F.when(F.col("_ord") == F.col("_first"), F.col("value")).otherwise(F.concat(F.lit(","), "value")).alias("value"))
    null = F.lit(None).cast(dict(lines.dtypes)["_ord"])
    has = not systems.isEmpty()
    heads = [(0, '{"version":1,"nodes":['), (1, '],"edges":['), *([(2, '],"systems":[')] if has else [])]
    heads = spark.createDataFrame(heads, "_section int, value string").select("_section", null.alias("_ord"), "value")
    tail = spark.createDataFrame([(3, "]}")], "_section int, value string").select("_section", null.alias("_ord"), "value")
    lines.unionByName(heads).unionByName(tail).orderBy("_section", F.asc_nulls_first("_ord")).select("value").write.mode("overwrite").text(path)


def coverage_lines(groups: DataFrame) -> DataFrame:
    """A Markdown table of ``groups(system, covered, total)``: whole percents, 0 of nothing is 0."""
    percent = F.expr("if(total = 0, 0, (100 * covered) div total)")
    return groups.select("system", F.format_string("| %s | %d | %d | %d%% |", "system", "covered", "total", percent).alias("value"))
