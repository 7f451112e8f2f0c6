"""Text functions as column expressions: labels, keys, markup, links, query strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of an effect's notation and the operation each stands for, in order of trial.
OP_PREFIXES = (("+^", "exp"), ("-^", "exp"), ("^^", "exp"), ("*^", "mult"), ("x^", "mult"), ("^", "exp"), ("x", "mult"), ("*", "mult"), ("/", "mult"), ("+", "add"), ("-", "add"))
#: Tags that are dropped from wikitext, their content kept.
DROPPED_TAGS = ("br", "sup", "sub", "ref", "small", "big", "span", "div", "center")


def slugify(c: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 to one hyphen, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def normalise_space(c: Column) -> Column:
    """Runs of white space, as Unicode has it, to one space; trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_tags(c: Column) -> Column:
    """Comments, scripts and styles go with their content, other tags become spaces."""
    bare = F.regexp_replace(c, r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>", "")
    return normalise_space(F.regexp_replace(bare, r"<[^>]*>", " "))


def plain_wikitext(c: Column, passes: int = 5) -> Column:
    """Wikitext to plain text: comments and file links go, innermost templates are unwrapped ``passes`` times, links give their label.

    ``keyword`` and ``zodiacbadge`` templates stand for their last positional argument, others for nothing.
    """
    t = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    t = F.regexp_replace(t, r"(?s)<math>\s*(.*?)\s*</math>", "$1")
    t = F.regexp_replace(t, r"(?i)\[\[File:[^\]]*\]\]", "")
    for _ in range(passes):
        t = F.regexp_replace(t, r"(?i)\{\{\s*(?:keyword|zodiacbadge)\s*(?:\|[^{}|]*)*?\|\s*([^{}|=]*?)\s*(?:\|[^{}|=]*=[^{}|]*)*\}\}", "$1")
        t = F.regexp_replace(t, r"\{\{[^{}]*\}\}", "")
    t = F.regexp_replace(t, r"\[\[[^\]|]*\|([^\]|]*)\]\]", "$1")
    t = F.regexp_replace(t, r"\[\[([^\]|]*)\]\]", "$1")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", " ")
    t = F.regexp_replace(t, rf"(?i)</?(?:{'|'.join(DROPPED_TAGS)})[^>]*>", "")
    return normalise_space(F.regexp_replace(t, r"'''|''", ""))


def derive_op(c: Column) -> Column:
    """The operation that a notation's prefix stands for, white space around it aside; null without one."""
    c, out = normalise_space(c), F.lit(None).cast("string")
    for prefix, op in reversed(OP_PREFIXES):
        out = F.when(F.startswith(c, F.lit(prefix)), op).otherwise(out)
    return out


def is_uncertain(*columns: Column) -> Column:
    """Whether any of the texts has a question mark."""
    return F.exists(F.array(*columns), lambda x: F.coalesce(F.contains(x, F.lit("?")), F.lit(False)))


def has_letter(c: Column) -> Column:
    return c.rlike(r"\p{L}")


def page_file(title: Column) -> Column:
    """A page's file name: no anchor, spaces to underscores, slashes doubled to underscores."""
    bare = F.substring_index(title, "#", 1)
    return F.concat(F.replace(F.replace(bare, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("__")), F.lit(".wikitext"))


def page_title(file: Column) -> Column:
    return F.replace(F.regexp_replace(file, r"\.wikitext$", ""), F.lit("__"), F.lit("/"))


def numbered_label(kind: Column, number: Column, name: Column) -> Column:
    """``Kind n (name)``, without the name where it is empty or says the same."""
    bare = F.concat(F.initcap(kind), F.lit(" "), number.cast("string"))
    return F.when((F.coalesce(name, F.lit("")) == "") | (name == bare), bare).otherwise(F.concat(bare, F.lit(" ("), name, F.lit(")")))


def url_component(c: Column) -> Column:
    """Percent-encoded as a part of a path or fragment: letters, digits and ``-_.!~*'()`` stay."""
    out = F.url_encode(c)
    for code, mark in (("+", "%20"), ("%7E", "~"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def safe_url(page: Column, base: str) -> Column:
    """A link under ``base`` to a page and its anchor: spaces to underscores, empty and dot segments dropped, the others percent-encoded; null without any."""
    title = F.replace(normalise_ends(F.substring_index(page, "#", 1)), F.lit(" "), F.lit("_"))
    anchor = F.replace(F.when(F.contains(page, F.lit("#")), F.substr(page, F.instr(page, "#") + 1)).otherwise(""), F.lit(" "), F.lit("_"))
    segments = F.transform(F.filter(F.split(title, "/"), lambda s: ~s.isin("", ".", "..")), url_component)
    return F.when(F.size(segments) > 0, F.concat(F.lit(base), F.array_join(segments, "/"), F.when(anchor != "", F.concat(F.lit("#"), url_component(anchor))).otherwise("")))


def normalise_ends(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


#: Sources that are not pages, and what is said of them.
SOURCES = {"observed": "observed in game", "il2cpp": "game binary", "discord": "community report"}


def source_label(source: Column, base: str) -> tuple[Column, Column]:
    """What is said of a source, and a link to it where it is a page (``wiki:`` and its title)."""
    page = F.when(F.startswith(source, F.lit("wiki:")), F.substr(source, F.lit(6)))
    said = source
    for key, text in SOURCES.items():
        said = F.when(source == key, text).otherwise(said)
    return F.coalesce(page, said), safe_url(page, base)


def query_param(url: Column, name: str) -> Column:
    """The first value of a query parameter, or null."""
    found = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.when(found != "", found)


def json_text(**columns: Column) -> Column:
    """One JSON object with sorted keys, without the fields that are null."""
    part = lambda k, v: F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":"'), F.replace(F.replace(v.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    return F.concat(F.lit("{"), F.concat_ws(",", *[part(k, columns[k]) for k in sorted(columns)]), F.lit("}"))
