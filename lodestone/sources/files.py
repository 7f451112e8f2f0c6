"""Sources: record files in YAML, page files, API responses, graph documents, inventories."""

from __future__ import annotations

import json
from typing import NamedTuple

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import written

#: The fields of each section, those that a record must have, and the words of closed vocabularies.
FIELDS = {
    "systems": "id string, name string, parent string",
    "nodes": "id string, name string, system string, kind string, wiki string, cost string, confidence string, effects array<struct<text:string,per_level:string,op:string>>, aliases array<string>",
    "edges": "`from` string, `to` string, rel string, op string, note string, targets_effect int, source string, confidence string",
    "suppress": "`from` string, `to` string, rel string, reason string",
}
REQUIRED = {"systems": ["id", "name"], "nodes": ["id", "name", "system", "kind"], "edges": ["from", "to", "rel", "source"], "suppress": ["from", "to", "rel", "reason"]}
WORDS = {
    ("nodes", "kind"): ["relic", "stat", "tree-node", "currency", "tarot-card", "upgrade", "group"],
    ("nodes", "confidence"): ["documented", "provisional", "unknown"],
    ("edges", "rel"): ["boosts", "unlocks", "requires"],
    ("suppress", "rel"): ["boosts", "unlocks", "requires"],
    ("edges", "op"): ["add", "mult", "exp"],
    ("edges", "confidence"): ["documented", "provisional", "uncertain"],
}
MANIFEST = "reader string, page string, system string, kind string, id_prefix string, name_prefix string, caption string, name_columns array<string>, effect_columns array<string>, per_level_column string, template string, name_field string, effect_fields array<string>, per_level_field string"


class Dataset(NamedTuple):
    """Sections of record files; ``problems`` has a row for each broken rule of form."""

    systems: DataFrame
    nodes: DataFrame
    edges: DataFrame
    suppress: DataFrame
    problems: DataFrame


def _parsed(text: str):
    """The nodes and the value of a YAML text, from one parse; libyaml's where it is there, whose faults the plain loader words."""
    for kind in (getattr(yaml, "CSafeLoader", yaml.SafeLoader), yaml.SafeLoader):
        loader = kind(text)
        try:
            root = loader.get_single_node()
            return root, None if root is None else loader.construct_document(root)
        except yaml.YAMLError:
            if kind is yaml.SafeLoader:
                raise
        finally:
            loader.dispose()


def _records(text: str, sections: list[str]):
    """(section, position, line, record as JSON, its field names, error) of one YAML text; no object tags are constructed."""
    try:
        root, value = _parsed(text)
    except yaml.YAMLError as e:
        yield None, 0, 0, None, [], str(e).split("\n")[0]
        return
    if value is None:
        return
    if not isinstance(value, dict):
        yield None, 0, 1, None, [], "the file is not a mapping"
        return
    marks = {k.value: [item.start_mark.line + 1 for item in v.value] for k, v in root.value if isinstance(v, yaml.SequenceNode)}
    for section, rows in value.items():
        if section not in sections or not isinstance(rows, list | type(None)):
            yield None, 0, 1, None, [], f"{section}: not a known section with a list"
            continue
        for k, row in enumerate(rows or []):
            ok = isinstance(row, dict)
            yield section, k, marks[section][k], json.dumps(row) if ok else None, list(row) if ok else [], None if ok else f"{section}.{k}: not a mapping"


def yaml_records(spark: SparkSession, path: str, sections: list[str]) -> DataFrame:
    """One row for each record of the YAML files at ``path``; each file is parsed in a task of its own."""

    def parse(batches):
        for b in batches:
            rows = [(p, *r) for p, t in zip(b["path"], b["value"]) for r in _records(t, sections)]
            yield pd.DataFrame(rows, columns=["path", "section", "_ord", "_line", "payload", "fields", "error"])

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.mapInPandas(parse, "path string, section string, _ord long, _line int, payload string, fields array<string>, error string")


def load_dataset(spark: SparkSession, path: str) -> Dataset:
    """Record files as DataFrames; an empty file has no records.

    ``_line`` is a record's line in its file, ``_ord`` its position, ``_set`` the fields that it sets.
    Files, records and fields of wrong form are in ``problems`` (severity, message, line, path).
    """
    rows = written(yaml_records(spark, path, list(FIELDS)), "records")  # each file is parsed once, not for every rule
    problem = lambda df, message: df.select(F.lit("error").alias("severity"), message.alias("message"), F.col("_line").alias("line"), "path")
    problems = problem(rows.where("error is not null"), F.col("error"))
    out = []
    for section, schema in FIELDS.items():
        own = rows.where((F.col("section") == section) & F.col("error").isNull()).withColumn("r", F.from_json("payload", schema))
        names = own.select("r.*").columns
        at = F.concat(F.lit(f"{section}."), F.col("_ord").cast("string"), F.lit("."))
        unknown = F.transform(F.array_except("fields", F.array(*map(F.lit, names))), lambda f: F.concat(at, f, F.lit(": unknown field")))
        broken = [F.when(F.col(f"r.`{f}`").isNull(), F.concat(at, F.lit(f"{f}: missing"))) for f in REQUIRED[section]]
        broken += [F.when(~F.col(f"r.`{f}`").isin(words), F.concat(at, F.lit(f"{f}: not one of {', '.join(words)}"))) for (of, f), words in WORDS.items() if of == section]
        said = own.select("_line", "path", F.explode(F.concat(unknown, F.array(*broken))).alias("said")).where("said is not null")
        problems = problems.unionByName(problem(said, F.col("said")))
        out.append(own.select("r.*", "_line", "_ord", F.col("fields").alias("_set")))
    return Dataset(*out, problems)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest entries with their position ``_entry``; see ``manifest_problems`` for their rules."""
    rows = yaml_records(spark, path, ["pages"])
    return rows.where("section = 'pages' and error is null").select(F.from_json("payload", MANIFEST).alias("r"), "_line", F.col("_ord").cast("int").alias("_entry")).select("r.*", "_line", "_entry")


def manifest_problems(manifest: DataFrame) -> DataFrame:
    """Entries that break a rule: ``(_entry, message)``."""
    wanted = F.coalesce("effect_columns", "effect_fields")
    scaling = F.coalesce("per_level_column", "per_level_field")
    rules = {
        "a page is named with underscores, not spaces": F.contains("page", F.lit(" ")),
        "a per-level column needs exactly one effect": scaling.isNotNull() & (F.size(wanted) != 1),
        "no effects are named": F.coalesce(F.size(wanted), F.lit(0)) < 1,
        "no name columns are named": (F.col("reader") == "wikitable") & (F.coalesce(F.size("name_columns"), F.lit(0)) < 1),
        "unknown reader": ~F.col("reader").isin("wikitable", "record_template"),
    }
    out = None
    for message, broken in rules.items():
        one = manifest.where(broken).select("_entry", F.lit(message).alias("message"))
        out = one if out is None else out.unionByName(one)
    a, b = manifest.select("_entry", F.col("id_prefix").alias("p")), manifest.select(F.col("id_prefix").alias("q")).distinct()
    # prefixes by their dashes: an equi-join instead of comparing all pairs
    cut = F.expr("explode(transform(sequence(1, greatest(size(split(p, '-')) - 1, 1)), k -> substring_index(p, '-', k)))").alias("q")
    clash = a.select("_entry", "p", cut).where("p <> q").join(b, "q")
    return out.unionByName(clash.select("_entry", F.concat(F.lit("id prefix "), "p", F.lit(" begins with "), "q")).toDF("_entry", "message"))


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files of a folder: ``page, text, bytes``."""
    from ..functions.text import page_title

    files = spark.read.option("pathGlobFilter", "*.wikitext").text(path, wholetext=True)
    title = page_title(F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))), "_(?!_)(?<!__)", " "))
    return files.select(title.alias("page"), F.col("value").alias("text"), F.col("_metadata.file_size").alias("bytes"))


def api_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages in saved API responses, JSON files in order of name: ``title, text``; a later title replaces an earlier one.

    A response with an error fails the query; pages without a revision or content are left out.
    """
    schema = "query struct<pages:map<string,struct<title:string,revisions:array<struct<slots:struct<main:struct<`*`:string>>>>>>>, error struct<code:string,info:string>"
    got = spark.read.schema(schema).json(path, multiLine=True).withColumn("_file", F.col("_metadata.file_name"))
    got = got.where(F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("API error "), F.coalesce("error.code", F.lit("unknown"))))).otherwise(F.lit(True)))
    page = got.select("_file", F.posexplode(F.map_values("query.pages")).alias("_at", "p"))
    text = page.select("_file", "_at", F.col("p.title").alias("title"), F.try_element_at("p.revisions", F.lit(1)).getField("slots").getField("main").getField("*").alias("text"))
    last = Window.partitionBy("title").orderBy(F.desc("_file"), F.desc("_at"))
    return text.where("title is not null and text is not null").withColumn("_n", F.row_number().over(last)).where("_n = 1").select("title", "text")


def graph_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and systems of graph documents; another version than 1 or a missing list fails the query."""
    f = FIELDS
    schema = f"version double, nodes array<struct<{_struct(f['nodes'])}>>, edges array<struct<{_struct(f['edges'])}>>, systems array<struct<{_struct(f['systems'])}>>"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    ok = (F.col("version") == 1) & F.col("nodes").isNotNull() & F.col("edges").isNotNull()
    doc = doc.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit("not a graph document of version 1"))))
    return tuple(doc.select(F.explode(k).alias("r")).select("r.*") for k in ("nodes", "edges", "systems"))


def _struct(ddl: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1].replace("from:", "`from`:").replace(",to:", ",`to`:")


def inventory(spark: SparkSession, path: str) -> DataFrame | None:
    """``(system, id)`` of a YAML mapping of systems to ids; None for a file that is empty or no mapping."""

    def parse(batches):
        for b in batches:
            maps = [m for t in b["value"] if isinstance(m := yaml.safe_load(t), dict)]
            yield pd.DataFrame([(str(k), str(i)) for m in maps for k, ids in m.items() for i in ids or []], columns=["system", "id"])

    out = spark.read.text(path, wholetext=True).mapInPandas(parse, "system string, id string")
    return None if out.isEmpty() else out
