"""Byte-level BPE encoding and decoding by a global shuffle of distinct words (operator 3).

Texts are cut into blocks of documents that one task reads in a row.

1. Every block's pre-tokens are made distinct and shuffled by hash buckets of the words; each distinct
   word of the corpus is encoded once, and its ids go back to every block that has the word.
2. The same blocks are read again and give, for every document, the positions' chunk numbers, a chunk
   being the pre-tokens from one space to the next.
3. Both meet by block: the documents' ids are reassembled in the order of positions.

Neither shuffle moves a frequent word more than once for each block, so a hot word is as light as
any other; the words of one block and bucket travel packed in one row.  Blocks are only good inside one reading order: a checksum of the block's
documents goes with both sides, and a difference stops the job.  ``docs`` should thus be a stored
table, as the queries have it, rather than the output of a shuffle.

Defined results: a null text is empty and has no ids; documents with equal or null ids stay rows of
their own; columns of other names are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import binary_array, key_runs, partitions, starts_of

BLOCK_BYTES, BLOCK_DOCS = 14 << 20, 50_000
#: Bytes of text that are cut into chunks at a time.
PIECE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of the lowest rank merges until none has a rank."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 400:
        return _merge_long(parts, ranks)
    pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
    while True:
        best, at = None, -1
        for i, rank in enumerate(pairs):
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return [ranks[p] for p in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])


def _merge_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked neighbours, for words of very many bytes."""
    import heapq

    n = len(parts)
    after, before, alive = [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, token = heapq.heappop(heap)
        j = after[i] if alive[i] else -1
        if j < 0 or parts[i] + parts[j] != token:
            continue
        parts[i], alive[j], after[i] = token, False, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (r := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (r, a, parts[a] + parts[b]))
    return [ranks[parts[i]] for i in range(n) if alive[i]]


#: A space or newline before more white space or the end, or characters that not every library takes as white space.
_ODD = re.compile(r"[ \n](?:\s|\Z)|[\x1c-\x1f\x85\u180e]")
#: White space of one byte, and first bytes of longer white space.
_MAY_BE_WHITE = np.zeros(256, bool)
_MAY_BE_WHITE[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def _uncut(data: np.ndarray, texts: list[bytes], ends: np.ndarray) -> np.ndarray:
    """Which texts hold white space that needs the pattern on the whole text."""
    cuts = (data == 0x20) | (data == 0x0A)
    after = np.r_[_MAY_BE_WHITE[data[1:]], True]
    after[np.unique(ends[ends > 0]) - 1] = True
    following = np.r_[data[1:], np.uint8(0)]
    odd = cuts & after | (data >= 28) & (data <= 31) | (data == 0xC2) & (following == 0x85) | (data == 0xE1) & (following == 0xA0)
    out = np.zeros(len(texts), bool)
    for k in np.unique(np.searchsorted(ends, np.flatnonzero(odd), side="right")).tolist():
        out[k] = _ODD.search(texts[k].decode()) is not None
    return out


def chunk_codes(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts as chunks: pieces that no pre-token spans, each from one space or newline to the next.

    A single space opens a chunk, as it joins the next word, and so does a newline; a text where one
    stands before other white space or the end is one chunk.  Gives the distinct chunks, the number of
    each text's chunks one after the other, and where each text's chunks end.  Texts are looked at some
    PIECE bytes at a time, so that masks of their bytes stay small.
    """
    sizes = np.fromiter(map(len, texts), "i8", len(texts))
    parts, counts = [], np.zeros(len(texts), "i8")
    lo = 0
    while lo < len(texts):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), PIECE)))
        some, lengths, ends = texts[lo:hi], sizes[lo:hi], np.cumsum(sizes[lo:hi])
        data = np.frombuffer(b"".join(some), "u1")
        if len(data):
            opens = (data == 0x20) | (data == 0x0A)
            opens &= ~np.repeat(_uncut(data, some, ends), lengths)
            opens[(ends - lengths)[lengths > 0]] = True
            starts = np.flatnonzero(opens)
            counts[lo:hi] = np.diff(np.r_[0, np.searchsorted(starts, ends)])
            parts.append(binary_array(data, np.r_[starts, len(data)]))
        lo = hi
    coded = pa.chunked_array(parts, pa.binary()).dictionary_encode().unify_dictionaries()
    if not parts:
        return pa.array([], pa.binary()), np.empty(0, "i4"), counts
    return coded.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in coded.chunks]), np.cumsum(counts)


def _words(chunks: pa.Array, compiled: regex.Pattern) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pre-tokens of chunks, how many each chunk has, and their numbers one after the other."""
    number: dict[str, int] = {}
    sizes, flat = array("i"), array("i")
    for at in range(0, len(chunks), 10_000):
        for c in chunks.slice(at, 10_000).to_pylist():
            found = compiled.findall(c.decode())
            sizes.append(len(found))
            flat.extend([number.setdefault(w, len(number)) for w in found])
    return [w.encode() for w in number], np.array(sizes, "i8"), np.array(flat, "i8")


def _checksum(texts: list[bytes]) -> int:
    return zlib.crc32(np.array([len(t) for t in texts], "<i8").tobytes())


def _ordered(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of a block's distinct words by bucket and bytes, and each one's bucket: the same in both readings."""
    order = np.array(sorted(range(len(words)), key=words.__getitem__), "i8")
    bucket = np.fromiter([zlib.crc32(words[i]) % buckets for i in order], "i8", len(words))
    stable = np.argsort(bucket, kind="stable")
    return order[stable], bucket[stable]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bytes]]]:
    """Documents in blocks of about BLOCK_BYTES and not more than BLOCK_DOCS: number, ids, texts."""
    ids: list = []
    texts: list[bytes] = []
    size, k, part = 0, 0, TaskContext.get().partitionId()
    some = (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500))
    for b in some:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            ids.append(i)
            texts.append(t or b"")
            size += len(texts[-1])
            if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                yield part << 24 | k, ids, texts
                ids, texts, size, k = [], [], 0, k + 1
                pa.default_memory_pool().release_unused()  # what a block took, for the workers beside this one
    if ids:
        yield part << 24 | k, ids, texts


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id_col, ids)``: a document's ids as little-endian unsigned 32-bit integers.

    Word and special-token rules are those of the pattern and ranks alone; no special tokens are
    known.  The ranks are read on the driver and broadcast: their size is the vocabulary's.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    source = docs.select(id_col, text_col)
    id_type_name, id_kind = dict(docs.dtypes)[id_col], to_arrow_type(docs.schema[id_col].dataType)

    buckets = 2 * partitions(spark)
    id_type = "<u2" if max(ranks.value.values()) < 65536 else "<u4"

    def words(batches):
        compiled = regex.compile(pattern)
        for block, _, texts in _blocks(batches):
            chunks = chunk_codes(texts)[0]
            some = (chunks.slice(at, 10_000).to_pylist() for at in range(0, len(chunks), 10_000))
            found = [w.encode() for w in {w for part in some for c in part for w in compiled.findall(c.decode())}]
            order, bucket = _ordered(found, buckets)
            distinct = [found[i] for i in order]
            starts = starts_of(bucket)
            ends = np.r_[starts[1:], len(bucket)]
            body = [_pack(np.array([len(w) for w in distinct[lo:hi]])) + b"".join(distinct[lo:hi]) for lo, hi in zip(starts, ends)]
            yield pa.record_batch({"bucket": bucket[starts], "block": np.full(len(starts), block, "i8"), "check": np.full(len(starts), _checksum(texts), "i8"), "body": pa.array(body, pa.binary())})

    def number(batches):
        known = ranks.value
        for t in key_runs(batches, ["bucket"], 1):
            own: dict[bytes, bytes] = {}
            out = []
            for body in t.column("body").to_pylist():
                sizes, at = _unpack(body)
                ids = []
                for n in sizes.tolist():
                    w = body[at : at + n]
                    at += n
                    if (x := own.get(w)) is None:
                        x = own[w] = np.array(merge_word(w, known), id_type).tobytes()
                    ids.append(x)
                out.append(_pack(np.array([len(x) for x in ids])) + b"".join(ids))
            yield from pa.table({"block": t.column("block"), "check": t.column("check"), "bucket": t.column("bucket"), "body": pa.array(out, pa.binary())}).to_batches()

    def sequences(batches):
        compiled = regex.compile(pattern)
        for block, ids, texts in _blocks(batches):
            chunks, codes, ends = chunk_codes(texts)
            words, sizes, own = _words(chunks, compiled)
            place = np.empty(len(words), "u4")
            place[_ordered(words, buckets)[0]] = np.arange(len(words), dtype="u4")
            order = np.argsort(-np.bincount(codes, minlength=len(sizes)), kind="stable")
            rank = np.empty(len(order), "i4")
            rank[order] = np.arange(len(order), dtype="i4")  # frequent chunks get small numbers
            many = sizes[order]
            first = (np.cumsum(sizes) - sizes)[order]
            flat = place[own[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(own))]]
            head = _pack(many) + flat.astype("<u4").tobytes()
            parts = np.split(rank[codes], ends[:-1])
            del chunks, words, own, flat, codes
            check = _checksum(texts)
            yield pa.record_batch({"block": pa.array([block], pa.int64()), "check": pa.array([check], pa.int64()), "doc": pa.nulls(1, id_kind), "body": pa.array([head], pa.binary()), "head": pa.array([True])})
            for at in range(0, len(ids), 2000):
                some = ids[at : at + 2000]
                yield pa.record_batch({"block": np.full(len(some), block, "i8"), "check": np.full(len(some), check, "i8"), "doc": pa.array(some, id_kind), "body": pa.array([_pack(x) for x in parts[at : at + 2000]], pa.binary()), "head": np.zeros(len(some), bool)})

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        top = right.filter(right.column("head"))
        rows = right.filter(pa.compute.invert(right.column("head")))
        if left.num_rows and left.column("check")[0].as_py() != top.column("check")[0].as_py():
            raise RuntimeError("a block's two readings differ: give encode() a stored table")
        listed: list[bytes] = []
        for body in left.sort_by("bucket").column("body").to_pylist():
            sizes, at = _unpack(body)
            for n in sizes.tolist():
                listed.append(body[at : at + n])
                at += n
        body = top.column("body")[0].as_py()
        sizes, at = _unpack(body)
        flat = np.frombuffer(body, "<u4", offset=at).tolist()
        by_rank = np.empty(len(sizes), object)
        lo = 0
        for i, n in enumerate(sizes.tolist()):
            by_rank[i] = listed[flat[lo]] if n == 1 else b"".join([listed[w] for w in flat[lo : lo + n]])
            lo += n
        out = [np.frombuffer(b"".join(by_rank[_unpack(x)[0]]), id_type).astype("<u4").tobytes() for x in rows.column("body").to_pylist()]
        return pa.table({id_col: rows.column("doc"), "ids": pa.array(out, pa.binary())})

    dictionary = (
        source.mapInArrow(words, "bucket long, block long, check long, body binary")
        .repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(number, "block long, check long, bucket long, body binary")
    )
    texts = source.mapInArrow(sequences, f"block long, check long, doc {id_type_name}, body binary, head boolean")
    return dictionary.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(reassemble, f"`{id_col}` {id_type_name}, ids binary")


def _pack(x: np.ndarray) -> bytes:
    """Numbers below 254 in a byte, below 65536 in three, others in five; reversed by _unpack."""
    small = x < 254
    mid = ~small & (x < 65536)
    lead = np.where(small, x, np.where(mid, 254, 255)).astype("u1")
    return len(x).to_bytes(4, "little") + lead.tobytes() + x[mid].astype("<u2").tobytes() + x[~small & ~mid].astype("<u4").tobytes()


def _unpack(b: bytes) -> tuple[np.ndarray, int]:
    """The numbers, and where they end."""
    n = int.from_bytes(b[:4], "little")
    lead = np.frombuffer(b, "u1", n, 4)
    out = lead.astype("i8")
    mid, big = lead == 254, lead == 255
    m = int(mid.sum())
    out[mid] = np.frombuffer(b, "<u2", m, 4 + n)
    k = int(big.sum())
    out[big] = np.frombuffer(b, "<u4", k, 4 + n + 2 * m)
    return out, 4 + n + 2 * m + 4 * k


def decode(encoded: DataFrame, ranks_path: str, keep: list[str], digest: bool = False) -> DataFrame:
    """Joins ids with the token-byte table: adds ``decoded`` (binary), or with ``digest`` its SHA-256.

    The table has a row for each id of the vocabulary, whatever the corpus, so it is broadcast and
    looked up by position, a document's ids at once.  An id outside the vocabulary is an error.
    """
    spark = encoded.sparkSession
    tokens = sorted((i, t) for t, i in read_ranks(ranks_path).items())
    offsets = np.zeros(tokens[-1][0] + 2, "i8")
    for i, t in tokens:
        offsets[i + 1] = len(t)
    shared = spark.sparkContext.broadcast((np.cumsum(offsets), np.frombuffer(b"".join(t for _, t in tokens), "u1")))
    last = "decoded_sha256" if digest else "decoded"

    def join(batches):
        at, data = shared.value
        for b in batches:
            out = []
            for raw in b.column("ids").to_pylist():
                ids = np.frombuffer(raw or b"", "<u4").astype("i8")
                lengths = at[ids + 1] - at[ids]
                where = np.repeat(at[ids] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
                text = data[where].tobytes()
                out.append(hashlib.sha256(text).hexdigest() if digest else text)
            yield pa.record_batch([*[b.column(k) for k in keep], pa.array(out, pa.string() if digest else pa.binary())], names=[*keep, last])

    kinds = dict(encoded.dtypes)
    return encoded.mapInArrow(join, ", ".join([*[f"`{k}` {kinds[k]}" for k in keep], f"{last} {'string' if digest else 'binary'}"]))


def op3_bpe(spark, sf_dir):
    """Encodes every text of ``documents`` and decodes the ids: digests of both."""
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    coded = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, P.PATTERN)
    coded = coded.withColumns({"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    return decode(coded, path, ["doc_id", "n_tokens", "ids_sha256"], digest=True)
