"""Queries that run the page parsers and the entity matcher.

The driver tables hold no wikitext, so each query first writes rows as pages; what the parsers read
from these must be the rows themselves, which its SQL takes straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import references as E
from .operators import wikitext as W
from .queries import query
from .sources import files
from .sources.shared import new_path


def _pages(rows, page, line, head, tail):
    """Pages of ``rows``: those of one ``page`` value, in order of ``k``, between head and tail."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", line.alias("line")))), lambda x: x["line"]), "")
    return rows.groupBy(page.alias("page")).agg(lines.alias("body")).select("page", F.concat(head, "body", tail).alias("text"))


def _text(c):
    return F.col(c).cast("string")


# --- tables and templates -------------------------------------------------------------------------


def _supplier_pages(t):
    s = t("supplier").select(F.col("s_suppkey").alias("k"), "s_name", "s_nationkey")
    line = F.concat(F.lit("|-\n| "), _text("k"), F.lit(" || [[p|"), F.col("s_name"), F.lit("]]\n| {{n|"), _text("s_nationkey"), F.lit("||x}}\n"))
    head = F.concat(F.lit('Intro\n{| class="wikitable"\n|+ Suppliers '), F.col("page"), F.lit("\n! key !! name\n! nation\n"))
    return _pages(s, F.floor(F.col("k") / 10).cast("string"), line, head, F.lit("|-\n! colspan=3 | end\n|}\nOutro"))


@query("select cast(s_suppkey // 10 as varchar) as page, 'Suppliers ' || (s_suppkey // 10) as caption, cast(s_suppkey as varchar) as key, '[[p|' || s_name || ']]' as name, '{{n|' || s_nationkey || '||x}}' as nation from supplier")
def wiki_tables(t):
    """Cells of tables, with links and templates that hold separators."""
    c = lambda k: F.trim(F.get("cells", F.lit(k)))
    return W.tables(_supplier_pages(t)).select("page", F.trim("caption").alias("caption"), c(0).alias("key"), c(1).alias("name"), c(2).alias("nation"))


@query("select cast(n_regionkey as varchar) as region, r_name, n_name, cast(n_nationkey as varchar) as n_nationkey from nation join region on r_regionkey = n_regionkey")
def wiki_row_spans(t):
    """A cell that spans the rows of its region's nations is carried down."""
    n = t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    counts = t("nation").groupBy("n_regionkey").agg(F.count("*").alias("many"), F.min("n_nationkey").alias("least"))
    n = n.join(counts, "n_regionkey").withColumn("k", F.col("n_nationkey"))
    spanning = F.when(F.col("k") == F.col("least"), F.concat(F.lit('| rowspan="'), _text("many"), F.lit('" | '), F.col("r_name"), F.lit("\n"))).otherwise(F.lit(""))
    line = F.concat(F.lit("|-\n"), spanning, F.lit("| "), F.col("n_name"), F.lit(" || "), _text("k"), F.lit("\n"))
    c = lambda k: F.trim(F.get("cells", F.lit(k)))
    return W.tables(_pages(n, _text("n_regionkey"), line, F.lit("{|\n! region !! nation !! key\n"), F.lit("|}"))).select(F.col("page").alias("region"), c(0).alias("r_name"), c(1).alias("n_name"), c(2).alias("n_nationkey"))


def _customer_pages(t):
    c = t("customer").select(F.col("c_custkey").alias("k"), "c_name", "c_mktsegment")
    line = F.concat(F.lit("{{Cust|"), _text("k"), F.lit("| Full  Name = "), F.col("c_name"), F.lit(" |note={{x|a=b|[[c|d]]}} = "), F.col("c_mktsegment"), F.lit("}} {{customer|no}}\n"))
    return _pages(c, F.floor(F.col("k") / 10).cast("string"), line, F.lit(""), F.lit("{{cust|open"))


@query("select cast(c_custkey // 10 as varchar) as page, c_name as name, '{{x|a=b|[[c|d]]}} = ' || c_mktsegment as note, cast(3 as bigint) as parts from customer")
def wiki_templates(t):
    """Bodies of balanced templates, their named fields, and their parts outside inner ones."""
    r = W.template_records(_customer_pages(t), "cust")
    return r.select("page", F.col("f")["full name"].alias("name"), F.col("f")["note"].alias("note"), (F.size(W.outside_parts("body")) - 1).cast("long").alias("parts"))


# --- manifest sweep -------------------------------------------------------------------------------


def _part_pages(t):
    p = t("part").select(F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_type")
    line = F.concat(F.lit("|-\n| '''"), F.col("p_name"), F.lit("''' || [[Brands|"), F.col("p_brand"), F.lit("]] || Type "), F.col("p_type"), F.lit(" || +"), _text("k"), F.lit("%\n"))
    return _pages(p, F.concat(F.lit("Parts "), F.floor(F.col("k") / 100).cast("string")), line, F.lit("{|\n|+ Parts\n! Name !! Brand !! Effect !! Level\n"), F.lit("|}"))


_MANIFEST = "_entry int, page string, reader string, caption string, name_columns array<string>, effect_columns array<string>, per_level_column string, template string, name_field string, effect_fields array<string>, per_level_field string, system string, kind string, id_prefix string, name_prefix string"


def _part_manifest(pages):
    """A wikitable entry for each page."""
    values = {"_entry": F.substring("page", 7, 20).cast("int"), "page": F.col("page"), "reader": F.lit("wikitable"), "caption": F.lit("Parts"), "name_columns": F.array(F.lit("Name"), F.lit("Brand")), "effect_columns": F.array(F.lit("Effect"), F.lit("Absent")), "per_level_column": F.lit("Level"), "effect_fields": F.array().cast("array<string>"), "system": F.lit("parts"), "kind": F.lit("part"), "id_prefix": F.lit("part")}
    return pages.select(*[values.get(n, F.lit(None)).cast(k).alias(n) for n, k in (x.split(" ") for x in _MANIFEST.split(", "))])


_PART = "select 'Parts ' || (p_partkey // 100) as wiki, p_name || ' ' || p_brand as name, 'Type ' || p_type as effect, '+' || p_partkey || '%' as per_level, p_partkey from part"


@query(f"select wiki, name, effect, per_level from ({_PART})")
def wiki_swept(t):
    """Records of a manifest's entries: plain names of two columns, effects, scale."""
    pages = _part_pages(t)
    return W.swept(pages, _part_manifest(pages)).select("wiki", "name", F.get("texts", F.lit(0)).alias("effect"), "per_level")


_MINTED = f"select *, 'part-' || trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') as id from ({_PART})"


@query(f"select id, name, wiki from (select *, row_number() over (partition by id order by p_partkey) n from ({_MINTED})) where n = 1")
def wiki_minted_nodes(t):
    """Of records that get one id the first in page order stays."""
    pages = _part_pages(t)
    return W.parse_swept(pages, _part_manifest(pages), None)[0].select("id", "name", "wiki")


@query(f"select id, wiki from (select *, row_number() over (partition by id order by p_partkey) n from ({_MINTED})) where n > 1")
def wiki_minted_again(t):
    """The records left out because their id was minted already, one warning each."""
    pages = _part_pages(t)
    return W.parse_swept(pages, _part_manifest(pages), None)[2].select("id", "wiki")


# --- fixed pages ----------------------------------------------------------------------------------


def _relics(t):
    n = t("nation").select(F.col("n_nationkey").alias("k"), "n_name", F.col("n_regionkey").alias("r"))
    effect = F.concat(F.lit("Boosts Relic "), _text("r"), F.lit("'s second effect (based on Fire Node "), (F.col("k") + 1).cast("string"), F.lit(") and "), F.lit("[[Ace of Cups]]"))
    line = F.concat(F.lit("|-\n| "), _text("k"), F.lit("\n| "), F.col("n_name"), F.lit("\n| x\n| "), effect, F.lit("\n| +5%\n| y\n"))
    page = _pages(n, F.lit("Relics"), line, F.lit("{| class=x\n! a\n|-\n! b\n"), F.lit("|}"))
    return W.parse_relics(page, None)


@query("select 'relic-' || n_nationkey as id, n_name as name, 'relics' as system, 'Boosts Relic ' || n_regionkey || '''s second effect (based on Fire Node ' || (n_nationkey + 1) || ') and Ace of Cups' as effect, '+5%' as per_level from nation")
def wiki_relic_nodes(t):
    e = F.get("effects", F.lit(0))
    return _relics(t)[0].select("id", "name", "system", e["text"].alias("effect"), e["per_level"].alias("per_level"))


@query("""select 'relic-' || n_nationkey as "from", 'relic-' || n_regionkey as "to", 1 as targets_effect from nation where n_nationkey <> n_regionkey
union all select 'fire-node-' || (n_nationkey + 1), 'relic-' || n_nationkey, null from nation
union all select 'relic-' || n_nationkey, 'tarot-ace-of-cups', null from nation""")
def wiki_relic_edges(t):
    """References in prose run to what they name, inputs the other way; a pointer tells the effect."""
    return _relics(t)[1].select("from", "to", "targets_effect")


def _refine(t):
    n = t("nation").select(F.col("n_nationkey").alias("k"), "n_name", F.col("n_regionkey").alias("r"))
    line = F.concat(F.lit("{{RN|"), _text("k"), F.lit("|effect= Gives "), F.col("n_name"), F.lit("|req= "), _text("r"), F.lit(", "), (F.col("k") + 100).cast("string"), F.lit("}}\n"))
    return W.parse_refine_tree(_pages(n, F.lit("Minerals/Refine Tree"), line, F.lit(""), F.lit("")), None, "Minerals/Refine_Tree")


@query("select 'refine-node-' || n_nationkey as id, 'Refine Node ' || n_nationkey as name, 'Gives ' || n_name as effect from nation")
def wiki_refine_nodes(t):
    return _refine(t)[0].select("id", "name", F.get("effects", F.lit(0))["text"].alias("effect"))


@query("""select 'refine-node-' || n_regionkey as "from", 'refine-node-' || n_nationkey as "to", 'requires' as rel from nation where n_regionkey <> 0 and n_regionkey <> n_nationkey
union all select 'refine-node-' || (n_nationkey + 100), 'refine-node-' || n_nationkey, 'requires' from nation""")
def wiki_refine_edges(t):
    """Prerequisites; 0 is none."""
    return _refine(t)[1].select("from", "to", "rel")


# --- references in prose --------------------------------------------------------------------------

_PROSE = "l_orderkey || ': refine tree node ' || l_suppkey || ' and Relics ' || l_linenumber || ', ' || (l_linenumber + 7) || ' & ' || (l_linenumber + 14) || ' or water NODE ' || l_linenumber || ', King of Swords'"


def _prose(t):
    n = F.col("l_linenumber")
    text = F.concat(_text("l_orderkey"), F.lit(": refine tree node "), _text("l_suppkey"), F.lit(" and Relics "), n.cast("string"), F.lit(", "), (n + 7).cast("string"), F.lit(" & "), (n + 14).cast("string"), F.lit(" or water NODE "), n.cast("string"), F.lit(", King of Swords"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", text.alias("text"))


@query(f"""with p as (select l_orderkey, l_linenumber, l_suppkey, {_PROSE} as text from lineitem)
select l_orderkey, l_linenumber, 'refine-node-' || l_suppkey as target, substr(text, strpos(text, 'refine'), length('refine tree node ' || l_suppkey)) as said from p
union all select l_orderkey, l_linenumber, 'relic-' || unnest([l_linenumber, l_linenumber + 7, l_linenumber + 14]), 'Relics ' || l_linenumber || ', ' || (l_linenumber + 7) || ' & ' || (l_linenumber + 14) from p
union all select l_orderkey, l_linenumber, 'water-node-' || l_linenumber, 'water NODE ' || l_linenumber from p
union all select l_orderkey, l_linenumber, 'tarot-king-of-swords', 'King of Swords' from p""")
def entity_references(t):
    """Every named entity of a text and the words that name it.

    A file's row groups hold very many short rows, each some 50 microseconds of matching: dealt to all tasks first.
    """
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "l_orderkey", "l_linenumber")
    x = _prose(lambda _: rows).select("l_orderkey", "l_linenumber", "text", F.explode(E.entity_spans("text")).alias("e"))
    return x.select("l_orderkey", "l_linenumber", F.col("e.target").alias("target"), F.substring(F.col("text"), F.col("e.start") + 1, F.col("e.stop") - F.col("e.start")).alias("said"))


@query("""select o_orderkey, unnest([' ' || o_orderkey || ') b', ' ' || o_custkey || ') tail']) as governed from orders""")
def governed_inputs(t):
    """What an input phrase governs: to the bracket that closes all around it, else to the end."""
    text = F.concat(F.lit("((a based on "), _text("o_orderkey"), F.lit(") b) then by amount of "), _text("o_custkey"), F.lit(") tail"))
    x = t("orders").select("o_orderkey", text.alias("text")).select("o_orderkey", "text", F.explode(E.governed_spans("text")).alias("e"))
    return x.select("o_orderkey", F.substring(F.col("text"), F.col("e.start") + 1, F.col("e.stop") - F.col("e.start")).alias("governed"))


@query("""select c_custkey, unnest(['n' || c_nationkey, 'segment']) as target, unnest([2, null]) as effect, unnest([true, true]) as vocabulary, unnest([false, true]) as input from customer""")
def vocabulary_references(t):
    """Vocabulary hits with what they point at, once each, and inputs."""
    words = t("nation").select(F.col("n_name").alias("surface"), F.concat(F.lit("n"), _text("n_nationkey")).alias("target")).union(t("customer").select("c_mktsegment", F.lit("segment")).distinct())
    nation = F.concat(F.lit("NATION_"), _text("c_nationkey"))
    text = F.concat(nation, F.lit("'s third effect, again "), nation, F.lit(" third effect (based on "), F.lower("c_mktsegment"), F.lit(", "), F.col("c_mktsegment"), F.lit("es)"))
    text = F.when(F.col("c_mktsegment") == F.upper("c_mktsegment"), F.replace(text, F.lower("c_mktsegment"), F.col("c_mktsegment"))).otherwise(text)
    x = E.referenced(t("customer").select("c_custkey", text.alias("text")), words).select("c_custkey", F.explode("refs").alias("r"))
    return x.select("c_custkey", "r.target", "r.effect", "r.vocabulary", "r.input")


@query("select o_orderkey, 'tarot-' || ['ace', 'two', 'three', 'four', 'five'][1 + o_custkey % 5] || '-of-' || ['cups', 'wands'][1 + o_custkey % 2] as target, case when o_custkey % 3 = 0 then 1 end as effect from orders")
def card_pointers(t):
    """Cards named by suit and number, with the effect where one is told."""
    k = F.col("o_custkey")
    text = F.concat(F.lit("see "), F.get(F.array(F.lit("Cups"), F.lit("Wands")), (k % 2).cast("int")), F.lit(" "), F.when(k % 5 == 0, "ace").otherwise((k % 5 + 1).cast("string")), F.lit("'s "), F.when(k % 3 == 0, "second effect").otherwise("effect"))
    return t("orders").select("o_orderkey", F.explode(E.card_references(text)).alias("r")).select("o_orderkey", "r.target", "r.effect")


@query("select o_orderkey, o_orderpriority || ' and ' || o_orderstatus || 'no' as plain from orders")
def plain_prose(t):
    """Wikitext of links, bold and templates as plain text."""
    text = F.concat(F.lit("'''[[Page|"), F.col("o_orderpriority"), F.lit("]]''' and  [["), F.col("o_orderstatus"), F.lit("]]<ref>no</ref>"))
    return t("orders").select("o_orderkey", T.plain_wikitext(text).alias("plain"))


# --- cards and elements ---------------------------------------------------------------------------

_CARD = "(select *, 'tarot-' || trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') as id, 'Relic ' || s_suppkey || ' and NATION_' || s_nationkey || ' (based on Fire Node 2)' as said from supplier)"


def _cards(t):
    s = t("supplier").select(F.col("s_suppkey").alias("k"), "s_name", "s_nationkey")
    said = F.concat(F.lit("Relic "), _text("k"), F.lit(" and NATION_"), _text("s_nationkey"), F.lit(" (based on Fire Node 2)"))
    line = F.concat(F.lit("{{Tarot Cards|card_name="), F.col("s_name"), F.lit("|effect= |effect1='''Swords''' 3's second effect|effect2="), said, F.lit("\n}}\n"))
    words = t("nation").select(F.concat(F.lit("NATION_"), _text("n_nationkey")).alias("surface"), F.concat(F.lit("n"), _text("n_nationkey")).alias("target"))
    return W.parse_cards(_pages(s, F.lit("Tarot"), line, F.lit("Cards\n"), F.lit("")), words)


@query(f"select id, s_name as name, 'Swords 3''s second effect' as first, said as second from {_CARD}")
def wiki_card_nodes(t):
    """Cards of a page with their effects in order; blank ones are left out."""
    text = lambda k: F.get("effects", F.lit(k))["text"]
    return _cards(t)[0].select("id", "name", text(0).alias("first"), text(1).alias("second"))


@query(f"""select id as "from", 'tarot-three-of-swords' as "to", 'boosts' as rel, 'Swords 3''s second effect' as note, 1 as targets_effect, 'provisional' as confidence from {_CARD}
union all select id, 'relic-' || s_suppkey, 'boosts', said, null, 'provisional' from {_CARD} union all select id, 'n' || s_nationkey, 'boosts', said, null, 'uncertain' from {_CARD}
union all select 'fire-node-2', id, 'boosts', said, null, 'provisional' from {_CARD}""")
def wiki_card_edges(t):
    """Suit and number, entities, vocabulary and inputs of cards, each with its note and confidence."""
    return _cards(t)[1].select("from", "to", "rel", "note", "targets_effect", "confidence")


def _element_page(t):
    """Factors by nation, whose name only its first row has, and upgrades of one element."""
    s = t("supplier").select("s_suppkey", "s_nationkey")
    first = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("least"))
    s = s.join(first, "s_nationkey").withColumn("k", F.struct("s_nationkey", "s_suppkey"))
    key = _text("s_suppkey")
    head = F.when(F.col("s_suppkey") == F.col("least"), F.concat(F.lit('! rowspan="9" | Nation'), _text("s_nationkey"), F.lit("\n"))).otherwise("")
    factor = F.concat(F.lit("\n|-\n"), head, F.lit("! Factor "), key, F.lit("\n| Boosts Relic "), key, F.lit("'s first effect\n| "), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Refine Node "), key)).otherwise("None"))
    upgrade = F.concat(F.lit("\n|-\n| "), key, F.lit("\n| 4 AP\n| Relic "), key, F.lit("'s first effect\nand more"))
    page = F.lit("Elements")
    a = _pages(s, page, factor, F.lit("=== Element Factors ===\n{| class=x\n! a"), F.lit("\n|}\n"))
    b = _pages(s, page, upgrade, F.lit("=== Element Upgrades ===\n==== Fire ====\n{|\n! b"), F.lit("\n|}\n"))
    return a.join(b.select("page", F.col("text").alias("more")), "page").select("page", F.concat("text", "more").alias("text"))


@query("""select 'nation' || s_nationkey || '-factor-' || s_suppkey as id, 'Nation' || s_nationkey || ' Factor ' || s_suppkey as name, 'stat' as kind, 'Boosts Relic ' || s_suppkey || '''s first effect' as effect from supplier
union all select 'fire-node-' || s_suppkey, 'Fire Node ' || s_suppkey, 'upgrade', 'Relic ' || s_suppkey || '''s first effect and more' from supplier""")
def wiki_element_nodes(t):
    """Factors under a header that is carried down, and upgrades with continued lines."""
    return W.parse_elements(_element_page(t), None)[0].select("id", "name", "kind", F.get("effects", F.lit(0))["text"].alias("effect"))


@query("""with f as (select s_suppkey as k, 'nation' || s_nationkey || '-factor-' || s_suppkey as id from supplier)
select 'relic-' || k as "from", id as "to", 'boosts' as rel, 'Boosts Relic ' || k || '''s first effect' as note, null::integer as targets_effect, 'provisional' as confidence from f
union all select 'refine-node-' || k, id, 'unlocks', 'Refine Node ' || k, null, 'documented' from f where k % 2 = 0
union all select 'fire-node-' || k, 'relic-' || k, 'boosts', 'Relic ' || k || '''s first effect and more', 0, 'provisional' from f""")
def wiki_element_edges(t):
    """Descriptions run into their factor, unlocks are documented, upgrades point at effects."""
    return W.parse_elements(_element_page(t), None)[1].select("from", "to", "rel", "note", "targets_effect", "confidence")


@query("""with p as (select *, p_partkey // 500 as doc, row_number() over (partition by p_partkey // 500 order by p_partkey) - 1 as k from part)
select 'node' as what, 'p' || p_partkey as id, p_name as said, cast(k as bigint) as ord, cast(2 + 6 * k as integer) as line from p
union all select 'problem', 'part-' || doc, 'nodes.' || k || '.kind: not one of relic, stat, tree-node, currency, tarot-card, upgrade, group', null, cast(2 + 6 * k as integer) from p where p_size = 7
union all select 'problem', 'part-' || doc, 'nodes.' || k || '.colour: unknown field', null, cast(2 + 6 * k as integer) from p where p_size = 8""")
def records_read_back(t):
    """Record files of 500 parts each, written as YAML and loaded again with their lines and problems."""
    spark = SparkSession.getActiveSession()
    folder = new_path(spark, "records")
    p = t("part").select(F.col("p_partkey").alias("k"), "p_name", "p_brand", "p_size", F.floor(F.col("p_partkey") / 500).alias("doc"))
    kind = F.when(F.col("p_size") == 7, "star").otherwise("stat")
    extra = F.when(F.col("p_size") == 8, "  colour: red\n").otherwise("  cost: 4 AP\n")
    line = F.concat(F.lit("- id: p"), _text("k"), F.lit("\n  name: '"), F.col("p_name"), F.lit("'\n  system: '"), F.col("p_brand"), F.lit("'\n  kind: "), kind, F.lit("\n"), extra, F.lit("  aliases: []\n"))
    texts = _pages(p, F.concat(F.lit("part-"), _text("doc")), line, F.lit("nodes:\n"), F.lit(""))
    texts.repartition("page").write.partitionBy("page").text(folder)
    got = files.load_dataset(spark, f"{folder}/*/*.txt")
    nodes = got.nodes.select(F.lit("node").alias("what"), "id", F.col("name").alias("said"), F.col("_ord").alias("ord"), F.col("_line").alias("line"))
    page = F.regexp_extract("path", "page=([^/]*)", 1)
    return nodes.unionByName(got.problems.select(F.lit("problem").alias("what"), page.alias("id"), F.col("message").alias("said"), F.lit(None).cast("long").alias("ord"), F.col("line").cast("int").alias("line")))
