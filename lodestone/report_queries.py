"""Queries that run the validator, the coverage report and the warnings of an extraction over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import coverage, graph, validate
from .operators import wikitext as W
from .page_queries import _part_manifest, _part_pages
from .queries import _TREE, _edges_of_entities, _tree, query


def _key(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


# --- validation -----------------------------------------------------------------------------------

_SYSTEMS = f"(select id, parent, 0 as _ord from {_TREE} union all select id, parent, 1 from {_TREE} where id like 'r%')"
_SIZED = "(select 'c' || c_custkey as id, case when c_custkey % 50 = 0 then 'lost' || c_custkey else 'n' || c_nationkey end as system, c_custkey % 3 as n, 2 * c_custkey as line from customer union all select 'c' || c_custkey, 'n' || c_nationkey, c_custkey % 3, 2 * c_custkey + 1 from customer where c_custkey % 40 = 0)"
_POINTING = "(select case when o_orderkey % 9 = 0 then 'gone' || o_custkey else 'c' || o_custkey end as f, 'c' || (o_orderkey % 300) as t, o_orderkey % 4 - 1 as e, o_orderkey as line from orders)"
_GONE = "from {0} where {1} not in (select id from {2})"


@query(f"""with recursive up as (select id, parent as top, 1 as hop from {_TREE} where parent is not null union all select u.id, g.parent, hop + 1 from up u join {_TREE} g on g.id = u.top where g.parent is not null and hop < 60)
select 'duplicate system id ''' || id || '''' as message, cast(1 as bigint) as line from {_TREE} where id like 'r%'
union all select 'system ''' || id || ''' has unknown parent ''' || parent || '''', 0 from {_TREE} where parent is not null and parent not in (select id from {_TREE})
union all select 'system ''' || id || ''' is in a parent cycle', 0 from (select distinct id from up where hop = 60)
union all select 'node ''' || id || ''' has undeclared system ''' || system || '''', line from {_SIZED} where system not in (select id from {_TREE})
union all select 'duplicate node id ''c' || c_custkey || '''', 2 * c_custkey + 1 from customer where c_custkey % 40 = 0
union all select 'unknown node ''' || f || ''' in ''from''', line {_GONE.format(_POINTING, 'f', _SIZED)}
union all select 'unknown node ''' || t || ''' in ''to''', line {_GONE.format(_POINTING, 't', _SIZED)}
union all select 'self-edge on ''' || f || '''', line from {_POINTING} where f = t
union all select 'edge to ''' || t || ''' points at effect ' || e || ' of ' || n, p.line from {_POINTING} p join (select distinct id, n from {_SIZED}) on id = t where e < 0 or e >= n""")
def dataset_problems(t):
    """All rules of the validator over one dataset with some of each fault."""
    tree = _tree(t).withColumns({"_line": F.lit(0), "_ord": F.lit(0)})
    systems = tree.unionByName(tree.where("id like 'r%'").withColumns({"_line": F.lit(1), "_ord": F.lit(1)}))
    k = F.col("c_custkey")
    c = t("customer").select(_key("c", "c_custkey").alias("id"), _key("n", "c_nationkey").alias("system"), F.array_repeat(F.lit("e"), (k % 3).cast("int")).alias("effects"), (2 * k).alias("_line"), k)
    nodes = c.withColumn("system", F.when(k % 50 == 0, _key("lost", "c_custkey")).otherwise(F.col("system"))).unionByName(c.where(k % 40 == 0).withColumn("_line", F.col("_line") + 1)).withColumn("_ord", F.col("_line"))
    o = F.col("o_orderkey")
    edges = t("orders").select(F.when(o % 9 == 0, _key("gone", "o_custkey")).otherwise(_key("c", "o_custkey")).alias("from"), F.concat(F.lit("c"), (o % 300).cast("string")).alias("to"), (o % 4 - 1).alias("targets_effect"), o.alias("_line"))
    return validate.problems(systems, nodes, edges).select("message", F.col("line").cast("long").alias("line"))


# --- coverage -------------------------------------------------------------------------------------

_DATASET = """n as (select 'c' || c_custkey as id, 'n' || c_nationkey as system, 'Customers/' || (c_custkey % 20) as wiki, c_custkey % 7 = 0 as stub, c_custkey % 3 > 0 as effects from customer union all select 'o' || o_orderkey, 'orders', null, false, false from orders),
e as (select 'c' || o_custkey as f, 'o' || o_orderkey as t, case when o_orderkey % 3 = 0 then 'requires' else 'boosts' end as rel from orders where o_orderkey % 5 > 0 union all select 'o' || o_orderkey, 'c' || o_custkey, 'unlocks' from orders where o_orderkey % 4 = 0 union all select 'c' || s_suppkey, 'gone' || s_suppkey, 'boosts' from supplier),
g as (select distinct f, t from e where f in (select id from n) and t in (select id from n)),
s as (select n.*, id in (select f from g union select t from g) as linked from n),
own as (select system as id, count(*) as d, count(*) filter (where linked) as c from s group by 1),
tree as (select x.id, x.parent, coalesce(d, 0) as d, coalesce(c, 0) as c from {tree} x left join own using (id)),
loops as (select 'c' || o_custkey as c, 'o' || o_orderkey as o from orders where o_orderkey % 20 in (4, 8, 12, 16) and 'c' || o_custkey in (select id from n))""".format(tree=_TREE)
_LINES = [
    (0, "k", "''", "''", "line", "(select unnest([0, 1, 2]) as k, unnest(['- Nodes: ' || (select count(*) from n), '- Edges: ' || (select count(*) from e), '- Stubs (confidence `unknown`): ' || (select count(*) from n where stub)]) as line)"),
    (1, "0", "system", "''", "'| ' || system || ' | ' || c || ' | ' || d || ' | ' || (100 * c // d) || '% |'", "(select id as system, c, d from own)"),
    (2, "0", "id", "''", "case when parent like 'r%' then '  ' else '' end || '- **' || id || '** — ' || (d + kd) || ' nodes, ' || (c + kc) || ' connected' || case when kd > 0 then ' (' || d || ' directly)' else '' end", "(select *, coalesce((select sum(k.d) from tree k where k.parent = tree.id and tree.id like 'r%'), 0)::bigint as kd, coalesce((select sum(k.c) from tree k where k.parent = tree.id and tree.id like 'r%'), 0)::bigint as kc from tree)"),
    (3, "0", "id", "''", "'- `' || id || '`'", "(select id from n where effects and id not in (select f from e where rel <> 'requires'))"),
    (4, "0", "id", "''", "'- `' || id || '`'", "(select id from s where not linked)"),
    (5, "-(count(*) over (partition by c))", "c", "id", "case when id = c then '- `' else '  → `' end || id || '`'", "(select distinct c, unnest([c, o]) as id from loops)"),
    (6, "-bytes", "page", "''", "'| `' || page || '` | ' || bytes || ' |'", "(select distinct 'Customers/' || (page_id % 30) as page, page_id % 30 * 100 as bytes from pages where 'Customers/' || (page_id % 30) not in (select wiki from n where wiki is not null))"),
    (7, "0", "system", "id", "'- `' || id || '`'", "(select 'inv' || s_suppkey % 3 as system, 'c' || s_suppkey * 20 as id from supplier where 'c' || s_suppkey * 20 not in (select id from n))"),
    (7, "0", "system", "''", "'### ' || system", "(select distinct 'inv' || s_suppkey % 3 as system from supplier where 'c' || s_suppkey * 20 not in (select id from n))"),
]


@query(f"with {_DATASET} " + " union all ".join(f"select {s} as section, cast({rank} as bigint) as rank, {name} as name, {item} as item, {value} as value from {of}" for s, rank, name, item, value, of in _LINES))
def coverage_report(t):
    """All sections' lines but their headings: counts, shares, hierarchy, unresolved, orphans, loops, unread pages, missing ids."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    none = F.array().cast("array<string>")
    nodes = t("customer").select(_key("c", "c_custkey").alias("id"), _key("n", "c_nationkey").alias("system"), F.concat(F.lit("Customers/"), (k % 20).cast("string"), F.lit("#x")).alias("wiki"), F.when(k % 7 == 0, "unknown").alias("confidence"), F.when(k % 3 > 0, F.array(F.lit("e"))).otherwise(none).alias("effects"))
    nodes = nodes.unionByName(t("orders").select(_key("o", "o_orderkey").alias("id"), F.lit("orders").alias("system"), F.lit(None).cast("string").alias("wiki"), F.lit(None).cast("string").alias("confidence"), none.alias("effects")))
    edges = t("orders").where(o % 5 > 0).select(_key("c", "o_custkey").alias("from"), _key("o", "o_orderkey").alias("to"), F.when(o % 3 == 0, "requires").otherwise("boosts").alias("rel"))
    edges = edges.unionByName(t("orders").where(o % 4 == 0).select(_key("o", "o_orderkey").alias("from"), _key("c", "o_custkey").alias("to"), F.lit("unlocks").alias("rel")))
    edges = edges.unionByName(t("supplier").select(_key("c", "s_suppkey").alias("from"), _key("gone", "s_suppkey").alias("to"), F.lit("boosts").alias("rel")))
    systems = _tree(t).select("id", F.col("id").alias("name"), "parent", F.xxhash64("id").alias("_ord"))
    inventory = t("supplier").select(F.concat(F.lit("inv"), (F.col("s_suppkey") % 3).cast("string")).alias("system"), F.concat(F.lit("c"), (F.col("s_suppkey") * 20).cast("string")).alias("id"))
    n = F.col("page_id") % 30
    pages = t("pages").select(F.concat(F.lit("Customers/"), n.cast("string")).alias("page"), (n * 100).alias("bytes")).distinct()
    return coverage.report(systems, nodes, edges, inventory, pages).where("part = 1").select("section", "rank", "name", "item", "value")


# --- extraction warnings --------------------------------------------------------------------------


@query("""with p as (select 'Parts ' || (p_partkey // 100) as wiki, p_partkey, 'part-' || trim(regexp_replace(lower(p_name || ' ' || p_brand), '[^a-z0-9]+', '-', 'g'), '-') as id from part),
m as (select *, row_number() over (partition by id order by p_partkey) as n, first(wiki) over (partition by id order by p_partkey) as owner from p)
select 'page ''' || wiki || ''': id ''' || id || ''' is minted already from ''' || owner || '''; the later record is left out' as message from m where n > 1
union all select 'page ''Empty'': the wikitable reader found no records' union all select 'page ''Absent'': there is no such page'""")
def wiki_warnings(t):
    """Warnings of a sweep: an entry without a page, one without records, records whose id was minted already."""
    pages = _part_pages(t)
    manifest = _part_manifest(pages)
    more = manifest.limit(1)  # two more entries, after any one
    more = more.withColumns({"_entry": F.lit(-1), "page": F.lit("Empty")}).unionByName(more.withColumns({"_entry": F.lit(-2), "page": F.lit("Absent")}))
    pages = pages.unionByName(more.where("page = 'Empty'").select("page", F.lit("no table").alias("text")))
    return W.warnings(pages, manifest.unionByName(more))


# --- cards, orders and sets -----------------------------------------------------------------------

_E = "(select 'n' || c_nationkey as src, 'c' || c_custkey as dst from customer union select 'c' || o_custkey, 'o' || o_orderkey from orders)"
_NAMES = "(select 'n' || n_nationkey as id, n_name as name from nation union all select 'c' || c_custkey, c_name from customer)"


@query(f"""with b as (select dst as id, 'in' as way, src as other from {_E} union all select src, 'out', dst from {_E})
select b.id, way, other, coalesce(name, other) as name, count(*) over (partition by b.id, way) as n from b left join {_NAMES} x on x.id = other""")
def node_cards(t):
    """Every node's edges both ways, with the other end's name or else its id, and their number."""
    e = _edges_of_entities(t)
    both = e.select(F.col("dst").alias("id"), F.lit("in").alias("way"), F.col("src").alias("other")).unionByName(e.select(F.col("src").alias("id"), F.lit("out").alias("way"), F.col("dst").alias("other")))
    names = t("nation").select(_key("n", "n_nationkey").alias("other"), F.col("n_name").alias("name")).unionByName(t("customer").select(_key("c", "c_custkey").alias("other"), F.col("c_name").alias("name")))
    counts = both.groupBy("id", "way").agg(F.count("*").alias("n"))
    return both.join(names, "other", "left").join(counts, ["id", "way"]).select("id", "way", "other", F.coalesce("name", "other").alias("name"), "n")


@query("select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey) n from lineitem) where n > 1")
def later_occurrences(t):
    """Each occurrence of a key after the first."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey"))
    return t("lineitem").withColumn("n", n).where("n > 1").select("l_orderkey", "l_linenumber", "l_partkey")


_LISTED = ("NATION_7", "NATION_3", "NATION_11")


@query(f"select n_regionkey, n_name, row_number() over (partition by n_regionkey order by coalesce(nullif(list_position({list(_LISTED)}, n_name), 0), 99), n_name) as place from nation")
def sibling_rank(t):
    """Siblings in the order of a list, then all others by name."""
    return graph.siblings(t("nation"), "n_regionkey", "n_name", _LISTED).select("n_regionkey", "n_name", "place")


@query("""with w as (select distinct lang, regexp_extract(text, '[a-zA-ZäöüßéèêçñóíáúÄÖÜÉÈÑÓÍÁ]+') as word from documents), k as (select lang, word, translate(lower(replace(word, 'ß', 'ss')), 'äöüéèêçñóíáú', 'aoueeecnoiau') as key from w where word <> '')
select lang, key, rank() over (partition by lang order by key) as place, count(*) as spellings from k group by 1, 2""")
def locale_rank(t):
    """The words that open documents, ranked within a language as readers sort them: accents and case aside."""
    word = F.regexp_extract("text", "[a-zA-ZäöüßéèêçñóíáúÄÖÜÉÈÑÓÍÁ]+", 0)
    words = t("documents").select("lang", word.alias("word")).where("word <> ''").distinct()
    plain = F.translate(F.lower(F.replace(F.col("word"), F.lit("ß"), F.lit("ss"))), "äöüéèêçñóíáú", "aoueeecnoiau")
    one = words.groupBy("lang", F.collate("word", "UNICODE_CI_AI").alias("word")).agg(F.count("*").alias("spellings"), F.min(plain).alias("key"))
    return graph.siblings(one, "lang", "word", (), "UNICODE_CI_AI").select("lang", "key", F.col("place").cast("long").alias("place"), "spellings")


@query("select coalesce(n_nationkey, k) as id, n_nationkey is not null as declared, cast(coalesce(n, 0) as bigint) as n from (select n_nationkey from nation where n_nationkey % 4 > 0) full join (select c_nationkey as k, count(*) as n from customer where c_nationkey % 3 > 0 group by 1) on n_nationkey = k")
def declared_or_counted(t):
    """Groups that are declared, counted or both."""
    declared = t("nation").where("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("id"), F.lit(True).alias("declared"))
    counted = t("customer").where("c_nationkey % 3 > 0").groupBy(F.col("c_nationkey").alias("id")).agg(F.count("*").alias("n"))
    return declared.join(counted, "id", "full").select("id", F.coalesce("declared", F.lit(False)).alias("declared"), F.coalesce("n", F.lit(0)).alias("n"))
