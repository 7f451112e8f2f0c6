"""Vocabulary matching: longest surface first, no overlaps, word boundaries."""

from __future__ import annotations

import bisect
import difflib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StringType

from ..sources.shared import release, written


def accepted(vocab: DataFrame) -> DataFrame:
    """Surfaces of 3 characters or more, or of 2 if all are capital letters; distinct pairs, with case sensitivity for all-capital ones."""
    v = vocab.select(F.trim(F.regexp_replace("surface", r"(?U)\s+", " ")).alias("surface"), "target")
    upper = (F.col("surface") == F.upper("surface")) & (F.col("surface") != F.lower("surface"))
    v = v.withColumn("case_sensitive", upper)
    return v.where((F.length("surface") >= 3) | ((F.length("surface") == 2) & upper & F.col("surface").rlike(r"^\p{L}+$"))).distinct()


def collisions(vocab: DataFrame) -> DataFrame:
    """Surfaces that stand for more than one target, whatever their case."""
    return vocab.groupBy(F.lower("surface").alias("folded")).agg(F.countDistinct("target").alias("targets")).where("targets > 1")


#: Tokens or candidates that a worker holds as Python objects, beside those of one text.
AT_ONCE = 20_000
#: Words, and runs of other characters that a surface without words may begin with.
_TOKEN = re.compile(r"(\w+)|(\W{3,})")
_WORD = re.compile(r"\w")


def tokens(low: str, known: bytes | None = None) -> dict[str, list[int]]:
    """A text's words and pairs of words side by side, and of other runs every three characters, with their places.

    With the bits of a sieve, only those that it lets through.
    """
    out: dict[str, list[int]] = {}
    known = known or b"\1"
    bits, hashed, last = len(known), zlib.crc32, None
    for m in _TOKEN.finditer(low):
        a, b = m.span()
        if m.lastindex == 1:
            token = low[a:b]
            if known[hashed(token.encode()) % bits]:
                out.setdefault(token, []).append(a)
            if last is not None:
                token = low[last:b]
                if known[hashed(token.encode()) % bits]:
                    out.setdefault(token, []).append(last)
            last = a
        else:
            for k in range(a, b - 2):
                token = low[k : k + 3]
                if known[hashed(token.encode()) % bits]:
                    out.setdefault(token, []).append(k)
    return out


def own_tokens(low: str) -> list[tuple[str, int]]:
    """Those that a surface has wherever it stands: its pairs of words, else its only word, else its first three characters."""
    words = [m.span() for m in re.finditer(r"\w+", low)]
    if len(words) > 1:
        return [(low[a:b], a) for (a, _), (_, b) in zip(words, words[1:])]
    return [(low[a:b], a) for a, b in words] or [(low[:3], 0)]


def _lowered(text: str) -> str:
    """In small letters, of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def settle(text: str, met: list[tuple[int, str, object, bool]], taken: list[tuple[int, int]]) -> list[tuple[int, int, str, object]]:
    """Hits ``(start, end, surface, target)`` of the candidates ``(start, surface, target, case sensitive)`` of a text.

    A candidate counts if the surface stands there, between no word characters.  The longest come first, then
    by surface, target and place; what overlaps one before it or a span taken already is dropped.
    """
    low, ordered = _lowered(text), []
    for a, surface, target, sensitive in met:
        b = a + len(surface)
        if a < 0 or low[a:b] != _lowered(surface) or sensitive and text[a:b] != surface:
            continue
        if (a and _WORD.match(text, a - 1)) or _WORD.match(text, b):
            continue
        ordered.append((-len(surface), surface, target, a))
    starts, out = sorted(taken), []
    for size, surface, target, a in sorted(ordered):
        b = a - size
        at = bisect.bisect_left(starts, (a, b))
        if (at == 0 or starts[at - 1][1] <= a) and (at == len(starts) or starts[at][0] >= b):
            starts.insert(at, (a, b))
            out.append((a, b, surface, target))
    return out


def surface_tokens(vocab: DataFrame) -> DataFrame:
    """Accepted surfaces by each of their tokens: ``token, offset, surface, target, case_sensitive``.

    A surface has all its words whole in a text, side by side.  Of targets of one surface the least counts.
    """

    def split(batches):
        for b in batches:
            rows = []
            for surface, target, sensitive in zip(b["surface"], b["target"], b["case_sensitive"]):
                rows += [(t, at, surface, target, sensitive) for t, at in dict(reversed(own_tokens(_lowered(surface)))).items()]
            yield pd.DataFrame(rows, columns=["token", "offset", "surface", "target", "case_sensitive"])

    kind = dict(vocab.dtypes)["target"]
    own = accepted(vocab).groupBy("surface").agg(F.min("target").alias("target"), F.first("case_sensitive").alias("case_sensitive"))
    return own.mapInPandas(split, f"token string, offset int, surface string, target {kind}, case_sensitive boolean")


def sieve(rows: DataFrame) -> np.ndarray:
    """A bit for the hash of each ``token``: what it lets through is a superset of the tokens, so it only spares traffic.

    Its size follows the number of tokens, to 8 MB at most; beyond, it lets more through.
    """
    bits = 1 << max(10, min(26, (64 * rows.agg(F.approx_count_distinct("token")).first()[0]).bit_length()))
    at = (F.crc32(F.col("token").cast("binary")) % bits).alias("at")
    words = rows.select(at).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("v")).collect()
    out = np.zeros(bits // 64, "i8")
    for r in words:
        out[r["word"]] = r["v"]
    return np.unpackbits(out.view("u1"), bitorder="little").view(bool)


def by_size(b: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lists in ``column`` have ``most`` elements together, or of one row.

    A batch holds 10,000 texts whatever they met; as Python objects their candidates take ten times the
    room that they have in the batch, so only some stand as such at a time.
    """
    ends = np.cumsum(b.column(column).value_lengths().to_numpy())
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield b.slice(lo, hi - lo)
        lo = hi


def hits(df: DataFrame, vocab: DataFrame, text_col: str, out: str = "hits", claimed: Callable[[str], list[tuple[int, int]]] | None = None) -> DataFrame:
    """``df`` with ``out``, the hits of its text as ``array<struct<start,stop,surface,target>>`` in order of place.

    Works on distinct texts and on vocabularies of any size: texts and surfaces meet in a join by the token of
    each surface that the fewest rows have, and candidates are settled text by text.  Two sieves keep other
    tokens from travelling: of the vocabulary while tokens are counted, of the chosen ones for the join.
    A frequent token draws only surfaces all of whose pairs of words are as frequent; adaptive execution splits
    its key.  Spans that ``claimed`` gives of a text are taken before.  Null texts have no hits.
    """
    spark = df.sparkSession
    target = dict(vocab.dtypes)["target"]
    kind = f"array<struct<start:int,stop:int,surface:string,target:{target}>>"
    result = to_arrow_type(df.sparkSession.createDataFrame([], f"x {kind}").schema["x"].dataType)
    key = ["_k1", "_k2"]

    def passing(sieve):
        shared = spark.sparkContext.broadcast(np.packbits(sieve))
        return lambda: np.unpackbits(shared.value).tobytes()  # a byte for each bit is the quickest to ask

    def rows_of(bits, batches, places):
        known, columns = bits(), [*key, "token", "places"] if places else ["token"]
        for b in batches:
            rows = []
            for r in zip(*(b[c] for c in b.columns)):
                found = tokens(_lowered(r[-1]), known)
                rows += [(*r[:-1], t, p) for t, p in found.items()] if places else [(t,) for t in found]
                if len(rows) >= AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            yield pd.DataFrame(rows, columns=columns)

    surfaces = written(surface_tokens(vocab))
    in_vocabulary = passing(sieve(surfaces))
    seen = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_text"))
    counts = seen.mapInPandas(lambda batches: rows_of(in_vocabulary, batches, False), "token string").groupBy("token").agg(F.count("*").alias("n"))
    ranked = surfaces.join(counts, "token", "left").groupBy("surface").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset", "target", "case_sensitive")).alias("r"))
    anchors = written(ranked.where("r.n > 0").select("r.token", "r.offset", "surface", "r.target", "r.case_sensitive"))
    release(surfaces)
    chosen = passing(sieve(anchors))

    def settled(batches):
        for b in batches:
            for some in by_size(b, "met", AT_ONCE):
                met = some.column("met").flatten()
                offset, surface, goal, sensitive = (met.field(k).to_pylist() for k in ("offset", "surface", "target", "case_sensitive"))
                sizes, places = met.field("places").value_lengths().to_numpy(), met.field("places").flatten().to_numpy()
                each = np.repeat(np.arange(len(sizes)), sizes)
                every = [(p - offset[i], surface[i], goal[i], sensitive[i]) for p, i in zip(places.tolist(), each.tolist())]
                ends = np.r_[0, np.cumsum(sizes)][np.cumsum(some.column("met").value_lengths().to_numpy())]
                rows, upto, lo = [], [0], 0
                for text, hi in zip(some.column("_text").to_pylist(), ends.tolist()):
                    rows += sorted(settle(text, every[lo:hi], claimed(text) if claimed else []))
                    upto.append(len(rows))
                    lo = hi
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, result.value_type)]
                found = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(result.value_type)))
                yield pa.record_batch([some.column("_k1"), some.column("_k2"), found], names=["_k1", "_k2", out])

    keyed = df.withColumns({"_k1": F.xxhash64(text_col), "_k2": F.xxhash64(F.lit("2"), text_col)})
    texts = keyed.where(F.col(text_col).isNotNull()).groupBy(*key).agg(F.first(text_col).alias("_text"))
    places = texts.mapInPandas(lambda batches: rows_of(chosen, batches, True), "_k1 long, _k2 long, token string, places array<int>")
    met = places.join(anchors, "token").groupBy(*key).agg(F.collect_list(F.struct("places", "offset", "surface", "target", "case_sensitive")).alias("met"))
    found = texts.join(met, key).mapInArrow(settled, f"_k1 long, _k2 long, `{out}` {kind}")
    return keyed.join(found, key, "left").select(*df.columns, F.coalesce(out, F.array().cast(kind)).alias(out))


def match(texts: DataFrame, vocab: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Hits ``(id, start, surface, target)``: longest surface first (ties by surface), none overlaps an earlier one."""
    own = texts.select(F.col(id_col), F.col(text_col).alias("_said"))
    return hits(own, vocab, "_said", "_hits").select(id_col, F.explode("_hits").alias("h")).select(id_col, "h.start", "h.surface", "h.target")


def resolve(hits: DataFrame, id_col: str) -> DataFrame:
    """Hits in order of start, each target of a text once."""
    return hits.groupBy(id_col, "target").agg(F.min("start").alias("start"))


def _tokens(strings: DataFrame) -> DataFrame:
    """``s, token``: each character of a string with the number of its occurrence there; an empty token for an empty string."""
    chars = F.regexp_extract_all("s", F.lit("(?s)."), F.lit(0))
    one = strings.select("s", F.explode(chars).alias("c")).groupBy("s", "c").agg(F.count("*").alias("n"))
    each = one.select("s", F.explode(F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda k: F.concat("c", k.cast("string")))).alias("token"))
    return each.unionByName(strings.where("s = ''").select("s", F.lit("").alias("token")))


@F.pandas_udf(DoubleType())
def _ratio(value: pd.Series, candidate: pd.Series) -> pd.Series:
    m, last, out = difflib.SequenceMatcher(), None, []
    for v, c in zip(value, candidate):
        if v != last:
            m.set_seq2(v)
            last = v
        m.set_seq1(c)
        out.append(m.ratio())
    return pd.Series(out, dtype="float64")


def closest(values: DataFrame, candidates: DataFrame) -> DataFrame:
    """The ``candidate`` most like ``value`` by matching blocks, at a ratio of 0.6 or more; ties to the greatest; null without one.

    A ratio of 0.6 is a common part of 3/10 of both lengths together, so the shorter string has 3/7 of
    the longer one's length at least, and 3/7 of either string's characters are in the other.  With all
    characters in one order, rarest first, such a pair shares one of the first 4/7 (and one) of each;
    only pairs that do, and whose lengths and character counts allow the ratio, are scored.

    Only the tokens' numbers are broadcast, a row for each character and number of its occurrence; how many
    rows strings make as tokens is not known before.
    """
    v = values.select(F.col("value").alias("s")).where("s is not null").distinct()
    c = candidates.select(F.col("candidate").alias("s")).where("s is not null").distinct()
    tv, tc = _tokens(v), _tokens(c)
    rarity = tv.unionByName(tc).groupBy("token").agg(F.count("*").alias("n"))

    def first(tokens):
        ranked = tokens.join(F.broadcast(rarity), "token").groupBy("s").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ts"))
        size = F.size("ts")
        return ranked.select("s", F.explode(F.slice("ts", F.lit(1), size - F.ceil(size * 3 / F.lit(7)).cast("int") + 1)).alias("t")).select("s", "t.token")

    a, b = first(tv).withColumnRenamed("s", "value"), first(tc).withColumnRenamed("s", "candidate")
    lv, lc = F.length("value"), F.length("candidate")
    pairs = a.join(b.hint("merge"), "token").where(20 * F.least(lv, lc) >= 6 * (lv + lc)).select("value", "candidate").distinct()
    counts = lambda s: F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))
    held = lambda s, x: F.length(s) - F.length(F.replace(F.col(s), x, F.lit("")))
    common = F.aggregate(F.transform(F.array_distinct(counts("value")), lambda x: F.least(held("value", x), held("candidate", x)) / F.length(x)), F.lit(0.0), lambda p, q: p + q)
    near = pairs.where(20 * common >= 6 * (lv + lc)).withColumn("ratio", _ratio("value", "candidate")).where("ratio >= 0.6")
    best = near.groupBy("value").agg(F.max(F.struct("ratio", "candidate")).alias("best")).select("value", F.col("best.candidate").alias("suggestion"))
    return values.join(best, "value", "left").select(*values.columns, "suggestion")


@F.pandas_udf(ArrayType(StringType()))
def split_outside(s: pd.Series) -> pd.Series:
    """Splits at commas outside round brackets; depth never falls below 0."""

    def cut(text):
        if text is None:
            return None
        out, held, depth = [], [], 0
        for c in text:
            if c == "," and not depth:
                out.append("".join(held))
                held = []
                continue
            depth = max(0, depth + (c == "(") - (c == ")"))
            held.append(c)
        return [*out, "".join(held)]

    return s.map(cut, na_action="ignore")
