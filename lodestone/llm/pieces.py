"""SentencePiece encoding and decoding for merge-type vocabularies (operator 13).

Encoding keeps an agenda of adjacent symbol pairs that make a piece, ordered by the piece's score and
then by place; the best pair merges and its new neighbours join the agenda, until none is left.  What
no piece covers becomes bytes.  A text is cut before each run of spaces where the vocabulary allows
it (no piece crosses such a cut, which is looked up), each distinct part is merged once for each worker,
and every part so merged is compared with the sentencepiece library's ids in the same Arrow batch; a
difference stops the job.  ``mismatches`` compares whole texts and decoded texts with the library's.

A task needs the vocabulary, a bounded store of known parts and one slice of texts.  Rows never meet,
so there is no shuffle, and hot sources or repeated rows gather nowhere.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text; repeated
rows, ties and null ids stay rows of their own; very long parts are merged whole in n log n steps;
columns of other names are ignored; an empty table gives no rows.  Null ids of a document decode as
an empty text, ids outside the vocabulary are an error.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  methods of arrays
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SPACE = "▁"
#: Fixed values of the model format: kinds of pieces, and the trainer's code for merge-type vocabularies.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MERGES = 2
#: Parts up to this length are kept by a worker, up to this number of them; others are merged each time.
KEPT_CHARS, KEPT_PARTS = 48, 400_000
SLICE_CHARS = 2 << 20
#: Up to this number of symbols the agenda is a list, above it a heap.
SHORT, NEVER = 40, float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a serialized message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        kind = tag & 7
        if kind == 0:
            value, at = number(at)
        else:
            size, at = number(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Vocabulary:
    """Pieces with scores and kinds, and the rules for spaces, of a model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    prefix: bool
    fallback: bool
    unknown_text: str

    @classmethod
    def of(cls, model: bytes) -> Vocabulary:
        pieces, scores, kinds = [], [], []
        trainer: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for field, body in _fields(model):
            if field == 1:
                x = dict(_fields(body))
                pieces.append(x.get(1, b"").decode())
                scores.append(struct.unpack("<f", x[2])[0] if 2 in x else 0.0)
                kinds.append(x.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(body))
            elif field == 3:
                rules = dict(_fields(body))
        if trainer.get(3, 1) != MERGES:
            raise ValueError("the model is not of the merge type")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("only models that leave characters and spaces as they are can be encoded here")
        return cls(pieces, scores, kinds, bool(rules.get(3, 1)), bool(trainer.get(35, 0)), trainer.get(44, " ⁇ ".encode()).decode())

    def __post_init__(self):
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER, UNUSED)}
        self.order = {p: -self.scores[i] for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if self.kinds[i] == UNUSED}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        user = sorted((p for p, i in self.ids.items() if self.kinds[i] == USER), key=len, reverse=True)
        self.user = re.compile("|".join(map(re.escape, user))) if user else None
        self.joins = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.runs: dict[str, tuple[int, ...]] = {}
        #: no piece goes on with a space after another character, so cuts before spaces are safe
        self.cuts = not user and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)

    def parts(self, text: str) -> list[str]:
        """The text with its spaces marked, in parts that no piece crosses."""
        if not text:
            return []
        marked = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        return _PARTS.findall(marked) if self.cuts else [marked]

    def symbols(self, part: str) -> tuple[list[str], set[int]]:
        """Single characters and whole user-defined symbols; the places of the latter, which never merge."""
        if self.user is None:
            return list(part), set()
        out: list[str] = []
        fixed: set[int] = set()
        at = 0
        for m in self.user.finditer(part):
            out += part[at : m.start()]
            fixed.add(len(out))
            out.append(m.group())
            at = m.end()
        return out + list(part[at:]), fixed

    def merge(self, part: str) -> list[int]:
        """Ids of one part by the agenda; runs of characters between which no piece reaches are merged apart."""
        if self.user is not None:
            return self._merged(*self.symbols(part))
        out: list[int] = []
        start, joins = 0, self.joins
        for i in range(1, len(part)):
            if part[i - 1 : i + 1] not in joins:
                out += self._run(part[start:i])
                start = i
        out += self._run(part[start:])
        return out

    def _run(self, run: str) -> tuple[int, ...]:
        ids = self.runs.get(run)
        if ids is None:
            ids = tuple(self._merged(list(run), set()))
            if len(run) <= KEPT_CHARS and len(self.runs) < KEPT_PARTS // 2:
                self.runs[run] = ids
        return ids

    def _merged(self, symbols: list[str], fixed: set[int]) -> list[int]:
        made: dict[str, tuple[str, str]] = {}
        if len(symbols) > SHORT or fixed or self.unused:
            symbols = agenda(symbols, fixed, self.order, self.unused, made)
        else:
            symbols = short_agenda(symbols, self.order)
        out: list[int] = []
        for s in symbols:
            self._emit(s, made, out)
        return out

    def _emit(self, symbol: str, made: dict[str, tuple[str, str]], out: list[int]) -> None:
        i = self.ids.get(symbol)
        if i is not None and (symbol not in self.unused or symbol not in made):
            out.append(i)
        elif symbol in made:  # pieces that the model lists as unused come apart again
            for half in made[symbol]:
                self._emit(half, made, out)
        elif self.fallback:
            out.extend(self.bytes[b] for b in symbol.encode())
        else:
            out.append(self.unknown)


_PARTS = re.compile(f"^[^{SPACE}]+|{SPACE}+[^{SPACE}]*")


def agenda(symbols: list[str], fixed: set[int], order: dict[str, float], unused: set[str], made: dict[str, tuple[str, str]]) -> list[str]:
    """Merges adjacent symbols, the pair of the best score (least ``order``) first and of equals the leftmost."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        rank = order.get(pair)
        if rank is not None and not (fixed and (i in fixed or i + 1 in fixed)):
            heap.append((rank, i, pair))
    heapify(heap)
    while heap:
        _, i, pair = heappop(heap)
        left = symbols[i]
        j = after[i]
        if left is None or j == n or len(left) + len(symbols[j]) != len(pair):
            continue  # one of the two has merged since
        if pair in unused:
            made[pair] = (left, symbols[j])
        symbols[i], symbols[j] = pair, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            longer = pair + symbols[k]
            rank = order.get(longer)
            if rank is not None and k not in fixed:
                heappush(heap, (rank, i, longer))
        h = before[i]
        if h >= 0:
            longer = symbols[h] + pair
            rank = order.get(longer)
            if rank is not None and h not in fixed:
                heappush(heap, (rank, h, longer))
    return [s for s in symbols if s is not None]


def short_agenda(symbols: list[str], order: dict[str, float]) -> list[str]:
    """The same for a few symbols: the agenda is a list in order of place, whose first least entry is the next."""
    agenda = [order.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
    while agenda and (best := min(agenda)) != NEVER:
        i = agenda.index(best)
        pair = symbols[i] + symbols[i + 1]
        symbols[i : i + 2] = [pair]
        del agenda[i]
        if i:
            agenda[i - 1] = order.get(symbols[i - 1] + pair, NEVER)
        if i < len(agenda):
            agenda[i] = order.get(pair + symbols[i + 1], NEVER)
    return symbols


class Encoder:
    """Known parts of one worker; new ones are merged and compared with the library's ids."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.vocabulary = Vocabulary.of(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        listed = [self.vocabulary.parts(t) for t in texts]
        known = self.known
        new = {p: array("i", self.vocabulary.merge(p)).tobytes() for p in set(chain.from_iterable(listed)).difference(known)}
        self._check(new)
        known.update(new)
        out = [np.frombuffer(b"".join(map(known.__getitem__, parts)), "i4") for parts in listed]
        full = len(known) > KEPT_PARTS
        for p in new:
            if full or len(p) > KEPT_CHARS:
                del known[p]
        return out

    def _check(self, new: dict[str, bytes]) -> None:
        """Parts begin with the space that the library itself puts before a text, so each can be given to it alone."""
        own = [p for p in new if not self.vocabulary.prefix or p[0] == SPACE]
        plain = [(p[1:] if self.vocabulary.prefix else p).replace(SPACE, " ") for p in own]
        for p, t, ids in zip(own, plain, self.library.encode(plain, num_threads=1)):
            if t and array("i", ids).tobytes() != new[p]:
                raise RuntimeError(f"the library encodes {t[:50]!r} differently")


_encoders: dict[int, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    """One for each worker process and model, as workers serve many tasks."""
    key = hash(model)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(model)
    return _encoders[key]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    keys: list = []
    texts: list[str] = []
    size = 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                keys.append(k)
                texts.append(t or "")
                size += len(texts[-1])
                if size >= SLICE_CHARS or len(keys) >= 5000:
                    yield keys, texts
                    keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, "i4")
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, "i4"), pa.int32()))


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id_col, ids)``, ids as ``array<int>``, without begin or end ids.

    The model file is read on the driver and broadcast: its size is the vocabulary's.
    """
    model = docs.sparkSession.sparkContext.broadcast(_model(model_path))
    kind, id_type = to_arrow_type(docs.schema[id_col].dataType), dict(docs.dtypes)[id_col]

    def run(batches):
        encoder = _encoder(model.value)
        for keys, texts in _slices(batches):
            yield pa.record_batch([pa.array(keys, kind), _lists(encoder.encode(texts))], names=[id_col, "ids"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"`{id_col}` {id_type}, ids array<int>")


class Decoder:
    """The table of the pieces' bytes, looked up for many documents at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.prefix = vocabulary.prefix
        self.plain = [
            b"" if k == CONTROL else vocabulary.unknown_text.encode() if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
            for p, k in zip(vocabulary.pieces, vocabulary.kinds)
        ]
        self.control = np.array([k == CONTROL for k in vocabulary.kinds])
        #: what stands first loses the space that encoding put before it
        self.spaced = np.array([p.startswith(SPACE) and k in (NORMAL, USER, UNUSED) for p, k in zip(vocabulary.pieces, vocabulary.kinds)])
        self.at = np.cumsum([0, *map(len, self.plain)])
        self.data = np.frombuffer(b"".join(self.plain), "u1")

    def texts(self, flat: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of documents whose ids stand one after the other, each up to its end."""
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.plain)):
            raise ValueError("an id outside the vocabulary")
        size = self.at[flat + 1] - self.at[flat]
        stop = np.cumsum(size)
        raw = self.data[np.repeat(self.at[flat] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)].tobytes()
        starts = np.r_[0, ends[:-1]]
        odd = set(np.searchsorted(ends, np.flatnonzero(self.control[flat]), side="right").tolist())
        out = []
        for k, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
            if lo == hi:
                out.append("")
            elif k in odd:
                out.append(self._with_control(flat[lo:hi]))
            else:
                first = int(stop[lo - 1]) if lo else 0
                out.append(_text(raw[first + int(self.prefix and self.spaced[flat[lo]]) : int(stop[hi - 1])]))
        return out

    def _with_control(self, ids: np.ndarray) -> str:
        """Control pieces are nothing, but bytes before and after one don't join."""
        out = []
        for is_control, run in groupby(ids.tolist(), lambda i: bool(self.control[i])):
            if not is_control:
                raw = b"".join(map(self.plain.__getitem__, run := list(run)))
                out.append(_text(raw[1:] if self.prefix and not out and self.spaced[run[0]] else raw))
        return "".join(out)


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="lodestone_each")


def _each(error: UnicodeError) -> tuple[str, int]:
    """Bytes that make no character are replaced one by one."""
    return "\ufffd", error.start + 1


codecs.register_error("lodestone_each", _each)


def decode(encoded: DataFrame, model_path: str, keep: list[str], out: str = "decoded") -> DataFrame:
    """Adds ``out``, the text of each row's ``ids``, to the columns ``keep``."""
    model = encoded.sparkSession.sparkContext.broadcast(_model(model_path))
    kinds = dict(encoded.dtypes)

    def run(batches):
        table = Decoder(_encoder(model.value).vocabulary)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = part.column("ids")
                ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
                texts = table.texts(ids.flatten().to_numpy(zero_copy_only=False).astype("i8"), ends)
                yield pa.record_batch([*[part.column(k) for k in keep], pa.array(texts, pa.string())], names=[*keep, out])

    return encoded.select(*keep, "ids").mapInArrow(run, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], f"{out} string"]))


def mismatches(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id_col, what)`` whose ids (``encode``) or decoded text (``decode``) the library has otherwise, whole texts compared."""
    model = docs.sparkSession.sparkContext.broadcast(_model(model_path))
    kind, id_type = to_arrow_type(docs.schema[id_col].dataType), dict(docs.dtypes)[id_col]

    def run(batches):
        encoder = _encoder(model.value)
        table = Decoder(encoder.vocabulary)
        for keys, texts in _slices(batches):
            theirs = encoder.library.encode(texts, num_threads=1)
            ours = encoder.encode(texts)
            back = table.texts(np.concatenate([*ours, np.empty(0, "i8")]).astype("i8"), np.cumsum([len(x) for x in ours]))
            decoded = encoder.library.decode(theirs, num_threads=1)
            bad = [(k, "ids" if a.tolist() != b else "text") for k, a, b, t, u in zip(keys, ours, theirs, back, decoded) if a.tolist() != b or t != u]
            yield pa.record_batch([pa.array([k for k, _ in bad], kind), pa.array([w for _, w in bad], pa.string())], names=[id_col, "what"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, f"`{id_col}` {id_type}, what string")


def op13_sentencepiece(spark, sf_dir):
    """Encodes every text of ``documents`` and decodes the ids: digests of both."""
    import public_tokenizers as P

    path = P.path("piece_bpe_32k.model")
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    coded = coded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256)})
    return decode(coded, path, ["doc_id", "n_tokens", "ids_sha256"]).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
