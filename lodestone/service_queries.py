"""Queries that fetch pages, publish snapshots and run the whole build over the driver tables."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as T
from .plans import build
from .queries import query
from .sources import api, publish
from .sources.files import Dataset
from .sources.shared import new_path

# --- a paginated service --------------------------------------------------------------------------

#: Pages of one chain of requests, and of one request.
_CHAIN, _ANSWER = 2000, 50


def _responses(t):
    """What a service would say that has the table's pages: 50 a request, a token where more follow, pages with a ``ref`` without a revision."""
    p = t("pages").withColumns({"start": F.floor(F.col("page_id") / _CHAIN).cast("int"), "request": F.floor(F.col("page_id") % _CHAIN / _ANSWER).cast("int")})
    slots = F.array(F.struct(F.struct(F.struct(F.coalesce("html", F.lit("")).alias("*")).alias("main")).alias("slots")))
    page = F.struct(F.regexp_replace(F.substring_index("url", "?", 1), "/[^/]*$", "").alias("title"), F.when(~F.contains("url", F.lit("ref=")), slots).alias("revisions"))
    listed = F.array_sort(F.collect_list(F.struct("page_id", page.alias("page"))))
    answer = p.groupBy("start", "request").agg(F.map_from_entries(F.transform(listed, lambda x: F.struct(x["page_id"].cast("string").alias("k"), x["page"].alias("v")))).alias("pages"))
    w = Window.partitionBy("start").orderBy("request")  # some forty requests
    token = lambda c: F.concat(F.lit("from-"), c.cast("string"))
    asked = F.when(F.row_number().over(w) > 1, token(F.col("request"))).otherwise("")
    after = F.lead("request").over(w)
    answer = answer.withColumns({"token": asked, "more": F.when(after.isNotNull(), F.struct(token(after).alias("gapcontinue"), F.lit("gapcontinue||").alias("continue")))})
    said = answer.select("start", "request", "token", F.to_json(F.struct(F.struct("pages").alias("query"), F.col("more").alias("continue"))).alias("payload"))
    # a start between others that has no pages has an answer too
    every = t("pages").agg(F.max("page_id").alias("top")).where("top is not null").select(F.explode(F.sequence(F.lit(0), F.floor(F.col("top") / _CHAIN).cast("int"))).alias("start"))
    return said.unionByName(every.join(said, "start", "left_anti").select("start", F.lit(0).alias("request"), F.lit("").alias("token"), F.lit("{}").alias("payload")))


@query("select regexp_replace(split_part(url, '?', 1), '/[^/]*$', '') as title, arg_max(coalesce(html, ''), page_id) as text from pages where not contains(url, 'ref=') group by 1")
def api_fetched(t):
    """Saved responses read by the data source, one chain of continuation tokens for each 2,000 pages; the later of two texts of a title stays."""
    spark = SparkSession.getActiveSession()
    folder = new_path(spark, "responses")
    responses = _responses(t)
    api.save_responses(responses, folder)
    starts = t("pages").agg(F.max("page_id")).first()[0]
    return api.fetched_pages(spark, saved=folder, starts=json.dumps([{}] * (0 if starts is None else starts // _CHAIN + 1)))


# --- snapshots ------------------------------------------------------------------------------------

_FILE = "replace(replace(split_part(url, '#', 1), ' ', '_'), '/', '__') || '.wikitext'"


@query(f"""with f as (select {_FILE} as file, bool_or(page_id % 10 <> 3) as stays from pages group by 1)
select file, case when stays then 'current' else 'stale' end as state from f""")
def snapshot_published(t):
    """A snapshot replaced by one of nine tenths of its pages, with the names that went; one of half the pages is refused."""
    spark = SparkSession.getActiveSession()
    root, pages = new_path(spark, "snapshot"), t("pages").select(F.col("url").alias("title"), F.col("html").alias("text"), "page_id")
    publish.publish_pages(spark, pages, root)
    stale = publish.publish_pages(spark, pages.where("page_id % 10 <> 3"), root)
    try:
        publish.publish_pages(spark, pages.where("page_id % 2 = 0"), root)
        raise RuntimeError("half of the pages must be refused")
    except publish.Refused:
        pass
    now = publish.current(spark, root, "pages")
    return now.select("file", F.lit("current").alias("state")).unionByName(stale.select("file", F.lit("stale").alias("state")))


# --- the build ------------------------------------------------------------------------------------

_NODE = "array<struct<text:string,per_level:string,op:string>>"


def _datasets(t, fault=False):
    """Parts and what they do for suppliers as generated records; suppliers, better part names, edges and rules as curated ones."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    null, words = F.lit(None).cast("string"), lambda *w: F.array(*map(F.lit, w))
    effect = lambda c: F.array(F.struct(F.col(c).alias("text"), null.alias("per_level"), null.alias("op"))).cast(_NODE)

    def nodes(df, at, id, name, system, effects, *said):
        aliases = F.lit(None).cast("array<string>")
        return df.select(id.alias("id"), name.alias("name"), system.alias("system"), F.lit("stat").alias("kind"), null.alias("wiki"), null.alias("cost"), F.lit("documented").alias("confidence"), effects.alias("effects"), aliases.alias("aliases"), F.col(at).cast("int").alias("_line"), F.col(at).cast("long").alias("_ord"), words("id", "name", *said).alias("_set"))

    def edges(df, source, note):
        return df.select(key("p", "l_partkey").alias("from"), key("s", "l_suppkey").alias("to"), F.lit("boosts").alias("rel"), null.alias("op"), note.alias("note"), F.lit(0).alias("targets_effect"), F.lit(source).alias("source"), F.lit("documented").alias("confidence"), F.lit(1).alias("_line"), (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("_ord"), words("from").alias("_set"))

    pairs = lambda where: t("lineitem").where(where).select("l_partkey", "l_suppkey").distinct()
    spark = SparkSession.getActiveSession()
    systems = t("part").select(F.col("p_brand").alias("id")).union(spark.createDataFrame([("suppliers",)], "id string")).distinct()
    systems = systems.select("id", F.col("id").alias("name"), null.alias("parent"), F.lit(1).alias("_line"), F.xxhash64("id").alias("_ord"), words("id", "name").alias("_set"))
    rules = pairs("l_discount = 0").select(key("p", "l_partkey").alias("from"), key("s", "l_suppkey").alias("to"), F.lit("boosts").alias("rel"), F.lit("free").alias("reason"), F.lit(1).alias("_line"), F.lit(1).cast("long").alias("_ord"), words("from").alias("_set"))
    part, own = t("part"), t("supplier")
    better = nodes(part.where("p_size < 5"), "p_partkey", key("p", "p_partkey"), F.concat(F.lit("Curated "), "p_name"), F.col("p_brand"), effect("p_type"))
    sup = nodes(own, "s_suppkey", key("s", "s_suppkey"), F.col("s_name"), F.lit("suppliers" if not fault else "supliers"), effect("s_name"), "system", "kind", "effects", "confidence")
    problems = spark.createDataFrame([], "severity string, message string, line int, path string")
    derived = Dataset(systems.where("false"), nodes(part, "p_partkey", key("p", "p_partkey"), F.col("p_name"), F.col("p_brand"), effect("p_type"), "system", "kind", "effects", "confidence"), edges(pairs("l_returnflag = 'R'"), "wiki:parts", null), rules.where("false"), problems)
    return derived, Dataset(systems, better.unionByName(sup), edges(pairs("l_quantity > 45"), "hand", F.lit("bulk")), rules, problems)


@query("""with d as (select distinct l_partkey p, l_suppkey s from lineitem where l_returnflag = 'R'), c as (select distinct l_partkey p, l_suppkey s from lineitem where l_quantity > 45),
e as (select p, s, max(k) as k from (select p, s, 0 as k from d union all select p, s, 1 from c) where (p, s) not in (select (l_partkey, l_suppkey) from lineitem where l_discount = 0) group by 1, 2)
select 'node' as what, 'p' || p_partkey as id, case when p_size < 5 then 'Curated ' || p_name else p_name end as said from part
union all select 'node', 's' || s_suppkey, s_name from supplier
union all select 'edge', 'p' || p || ' s' || s, case k when 1 then 'hand bulk' else 'wiki:parts' end from e
union all select 'graph', 'lines', cast((select count(*) from part) + (select count(*) from supplier) + (select count(*) from e) + (select count(distinct p_brand) + 1 from part) as varchar)
union all select 'report', 'nodes', '- Nodes: ' || ((select count(*) from part) + (select count(*) from supplier))
union all select 'problem', 'warnings', cast((select count(*) from (select distinct l_partkey, l_suppkey from lineitem where l_discount = 0) r where (l_partkey, l_suppkey) not in (select (p, s) from d union select (p, s) from c)) as varchar)""")
def build_published(t):
    """The build of generated and curated records; one with undeclared systems is refused after it and changes nothing."""
    spark = SparkSession.getActiveSession()
    root = new_path(spark, "build")
    build.build(spark, *_datasets(t), root)
    try:
        build.build(spark, *_datasets(t, fault=True), root)
        raise RuntimeError("a build with errors must be refused")
    except publish.Refused:
        pass
    table = lambda name: publish.current(spark, root, name)
    count = lambda df, what, id: df.agg(F.count("*").cast("string").alias("said")).select(F.lit(what).alias("what"), F.lit(id).alias("id"), "said")
    nodes = table("nodes").select(F.lit("node").alias("what"), "id", F.col("name").alias("said"))
    edges = table("edges").select(F.lit("edge").alias("what"), F.concat_ws(" ", "from", "to").alias("id"), F.concat_ws(" ", "source", "note").alias("said"))
    said = table("report").where("value like '- Nodes: %'").select(F.lit("report").alias("what"), F.lit("nodes").alias("id"), F.col("value").alias("said"))
    return nodes.unionByName(edges).unionByName(count(table("graph"), "graph", "lines")).unionByName(said).unionByName(count(table("problems").where("severity = 'warning'"), "problem", "warnings"))
