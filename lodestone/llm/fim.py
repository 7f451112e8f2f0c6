"""Fill-in-middle transformation by an event scan of each text (operator 11).

A text is cut into units, and a prefix, a middle and a suffix of whole units change places around
three sentinels.  One Aho-Corasick automaton reads a text once and reports its events: the ASCII
characters at which a unit may end, and sentinels, which leave a text plain.  Between two events
nothing changes its class, so a gap's units follow from its length; the end of the unit of any rank is
looked up among the events, and units themselves are never made.

Units: ``line`` (``[^\\n]*\\n|[^\\n]+``), ``word`` (a word with the ASCII white space after it) and
``char`` (a code point, where a gap has as many units as characters).

Every text is one row of one task and rows never meet, so hot sources and repeated rows cost what they
hold, and a lost task repeats only its own rows.

Defined results: a null text is empty; an empty text, one with a sentinel and one above the rate stay
plain; a null id is written as nothing behind the seed; repeated rows and ids each give a row, and equal
ids choose by the same hashes; columns of other names are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: The ASCII characters at which a unit may end.
BREAKS = {"line": "\n", "word": " \t\n\v\f\r", "char": ""}
SLICE_CHARS = 4 << 20


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or any(not m or any(m[:k] == o[-k:] for o in marks for k in range(1, len(m) + 1) if (m, k) != (o, len(m))) for m in marks):
            raise ValueError("sentinels must differ, and none may begin as one ends: outputs could not be read back")


def scanner(unit: str, sentinels: Sentinels):
    """The automaton of a unit's breaks and the sentinels; a break's value is 1, a sentinel's 0."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for c in BREAKS[unit]:
        automaton.add_word(c, 1)
    for s in (sentinels.prefix, sentinels.suffix, sentinels.middle):
        automaton.add_word(s, 0)
    automaton.make_automaton()
    return automaton


class Ranks:
    """Units of a text from its breaks' positions: how many there are, and where the first r of them end."""

    def __init__(self, unit: str, breaks: list[int], length: int):
        at = np.array(breaks, "i8")
        if unit == "word":  # white space belongs to the word before it, so only the last break of a run ends a unit
            at = at[np.r_[at[1:] != at[:-1] + 1, True]] if len(at) else at
        self.ends = at + 1
        last = int(self.ends[-1]) if len(at) else 0
        # what follows the last break has no event: one unit, or one for each character
        self.base, self.tail = last, length - last if unit == "char" else int(length > last)
        self.step = 1 if unit == "char" else length - last
        self.n = len(self.ends) + self.tail

    def end(self, rank: int) -> int:
        over = rank - len(self.ends)
        if over > 0:
            return self.base + over * self.step
        return int(self.ends[rank - 1]) if rank else 0


def events(automaton, text: str) -> tuple[list[int], bool]:
    """Positions of the breaks of a text, and whether it holds a sentinel."""
    breaks: list[int] = []
    marked = False
    for at, is_break in automaton.iter(text):
        if is_break:
            breaks.append(at)
        else:
            marked = True
    return breaks, marked


def hashes(seed: int, key: object) -> list[int]:
    """The first four 8-digit groups of the hash of ``seed:key``, as numbers."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transform(
    docs: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50,
    sentinels: Sentinels = Sentinels(), id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows ``(id_col, n, form, prefix_chars, middle_chars, output)``: each text with its middle at the end.

    ``rate`` percent of the texts are transformed, ``spm`` percent of those with the suffix first.
    """
    if unit not in BREAKS:
        raise ValueError(f"units are {', '.join(BREAKS)}")
    source = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    kind, id_type = to_arrow_type(docs.schema[id_col].dataType), dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = scanner(unit, sentinels)
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for key, text in ((k, t) for part in (b.slice(at, 256) for at in range(0, b.num_rows, 256)) for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                rows.append((key, *_placed(automaton, unit, sentinels, text, hashes(seed, key), rate, spm)))
                size += len(text)
                if size >= SLICE_CHARS or len(rows) >= 5000:
                    yield _batch(rows, id_col, kind)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, id_col, kind)

    return source.mapInArrow(run, f"`{id_col}` {id_type}, n long, form string, prefix_chars long, middle_chars long, output string")


def _placed(automaton, unit: str, sentinels: Sentinels, text: str, h: list[int], rate: int, spm: int) -> tuple:
    breaks, marked = events(automaton, text)
    ranks = Ranks(unit, breaks, len(text))
    if not text or marked or h[2] % 100 >= rate:
        return ranks.n, "plain", None, None, text
    low, high = sorted((h[0] % (ranks.n + 1), h[1] % (ranks.n + 1)))
    a, b = ranks.end(low), ranks.end(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm:
        return ranks.n, "spm", a, b - a, sentinels.suffix + suffix + sentinels.prefix + prefix + sentinels.middle + middle
    return ranks.n, "psm", a, b - a, sentinels.prefix + prefix + sentinels.suffix + suffix + sentinels.middle + middle


def _batch(rows: list[tuple], id_col: str, kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])


def restored(output: Column | str, form: Column | str, sentinels: Sentinels = Sentinels()) -> Column:
    """The exact text again, from an output and its form alone: a transformed text holds each sentinel once."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    marks = "|".join(f"\\Q{m}\\E" for m in (sentinels.prefix, sentinels.suffix, sentinels.middle))
    part = F.split(output, marks, -1)
    at = lambda k: F.try_element_at(part, F.lit(k))
    return F.when(form == "psm", F.concat(at(2), at(4), at(3))).when(form == "spm", F.concat(at(3), at(4), at(2))).otherwise(output)


def op11_fill_in_middle(spark, sf_dir):
    """Every text of ``documents`` cut into lines, its middle moved to the end, and put together again."""
    moved = transform(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored("output", "form")).alias("restored_sha256"))


def op11_sql() -> str:
    """The same by lists of lines; the text is rebuilt from the output by its sentinels' places."""
    return """
with d as (
    select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u from documents),
k as (
    select *, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) % (len(u) + 1) as a, cast('0x' || substr(h, 9, 8) as bigint) % (len(u) + 1) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || substr(h, 17, 8) as bigint) % 100 >= 100 then 'plain'
            when cast('0x' || substr(h, 25, 8) as bigint) % 100 < 50 then 'spm' else 'psm' end as form
    from d),
c as (
    select doc_id, t, n, form, array_to_string(list_slice(u, 1, least(a, b)), '') as p, array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') as m, array_to_string(list_slice(u, greatest(a, b) + 1, n), '') as s
    from k),
o as (
    select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end as o from c),
r as (
    select *, case form when 'plain' then o
        when 'psm' then split_part(substr(o, 4), '<S>', 1) || split_part(o, '<M>', 2) || split_part(split_part(o, '<S>', 2), '<M>', 1)
        else split_part(split_part(o, '<P>', 2), '<M>', 1) || split_part(o, '<M>', 2) || split_part(substr(o, 4), '<P>', 1) end as x
    from o)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars, sha256(o) as output_sha256, sha256(x) as restored_sha256
from r"""
