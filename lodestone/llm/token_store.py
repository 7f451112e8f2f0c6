"""Token ids as binary shards with a minimal perfect hash index (operator 7).

A stored dataset is a table with one row for each shard, in any store that Spark writes to:

* ``payload``: the ids of the shard's documents end to end, each in ``width`` bytes, little-endian;
* ``displace``, ``fingerprints``, ``starts``, ``lengths``: a minimal perfect hash of the shard's keys.
  A key's bucket gives a displacement, which gives a slot; the slot's 32-bit fingerprint tells keys
  of the shard from others, and its start and length give the document's ids.  A keyed read looks at
  one bucket and one slot, whatever the shard's size;
* ``keys``: the keys in ascending order, for scans; ``first_key`` and ``last_key`` for pruning;
* ``shard``: ascending with the keys; ``n_ids`` and ``n_docs``.

Keys are document ids; a null id sorts first.  Documents of equal id are told apart by their
occurrence in their shard (0, 1, ...), in the order of their texts' first 64 characters.

Defined results: a null text is empty and has the end id alone; an empty table gives an empty
dataset; other columns are ignored; a document longer than a shard gets a shard of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, new_path, partitions

SHARD_IDS = 1 << 20
SCHEMA = "shard long, first_key long, last_key long, n_docs long, n_ids long, width int, displace binary, fingerprints binary, starts binary, lengths binary, keys binary, payload binary"
#: A stored key: document id (0 if null), whether it is null, and which of its occurrences it is.
KEY = np.dtype([("id", "<i8"), ("null", "u1"), ("occurrence", "<u4")])


def hashes(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key."""
    return mix64(mix64(keys["id"].astype("i8").view("u8") + np.uint64(0x9E3779B97F4A7C15)) ^ (keys["occurrence"].astype("u8") * np.uint64(2) + keys["null"]))


def slot_of(h: np.ndarray, displace: np.ndarray, n: int) -> np.ndarray:
    """The slot of each hash, by its bucket's displacement."""
    return (mix64(h + displace[(h >> np.uint64(32)) % np.uint64(len(displace))].astype("u8") * np.uint64(0xD1342543DE82EF95)) % np.uint64(n)).astype("i8")


def perfect_hash(h: np.ndarray) -> np.ndarray:
    """Displacements that send n distinct hashes to n slots, one each; largest buckets choose first."""
    n = len(h)
    buckets = max(1, (n + 2) // 3)
    bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype("i8")
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    ends = np.cumsum(sizes)
    taken = np.zeros(n, bool)
    displace = np.zeros(buckets, "u4")
    for b in np.argsort(-sizes, kind="stable"):
        if not sizes[b]:
            break
        own = h[order[ends[b] - sizes[b] : ends[b]]]
        base, trials = 0, 8
        while True:
            trial = np.arange(trials, dtype="u8")
            where = (mix64(own[None, :] + (trial[:, None] + np.uint64(base)) * np.uint64(0xD1342543DE82EF95)) % np.uint64(n)).astype("i8")
            free = ~taken[where].any(1)
            for d in np.flatnonzero(free):
                if len(set(where[d].tolist())) == len(own):
                    break
            else:
                base, trials = base + trials, min(4 * trials, 4096)
                if base > 1 << 30:
                    raise RuntimeError("two keys of a shard have one hash")
                continue
            taken[where[d]] = True
            displace[b] = base + int(d)
            break
    return displace


def pack_shard(shard: int, keys: np.ndarray, documents: list[np.ndarray]) -> dict:
    lengths = np.array([len(x) for x in documents], "u4")
    starts = np.cumsum(lengths.astype("u8")) - lengths
    flat = np.concatenate(documents) if documents else np.empty(0, "u4")
    width = 2 if not len(flat) or flat.max() < 65536 else 4
    h = hashes(keys)
    displace = perfect_hash(h)
    slots = slot_of(h, displace, len(h))
    prints, by_start, by_length = np.empty(len(h), "<u4"), np.empty(len(h), "<u8"), np.empty(len(h), "<u4")
    prints[slots], by_start[slots], by_length[slots] = h.astype("u4"), starts, lengths
    ids = keys["id"][keys["null"] == 0]
    return dict(shard=shard, first_key=int(ids[0]) if len(ids) else None, last_key=int(ids[-1]) if len(ids) else None, n_docs=len(h), n_ids=len(flat), width=width, displace=displace.tobytes(), fingerprints=prints.tobytes(), starts=by_start.tobytes(), lengths=by_length.tobytes(), keys=keys.tobytes(), payload=flat.astype(f"<u{width}").tobytes())


def read_keys(row: dict, keys: np.ndarray) -> list[np.ndarray | None]:
    """Each key's ids in a shard by its index; None for a key that the shard doesn't hold."""
    h = hashes(keys)
    slots = slot_of(h, np.frombuffer(row["displace"], "<u4"), row["n_docs"])
    held = np.frombuffer(row["fingerprints"], "<u4")[slots] == h.astype("u4")
    starts, lengths = np.frombuffer(row["starts"], "<u8")[slots], np.frombuffer(row["lengths"], "<u4")[slots]
    payload = np.frombuffer(row["payload"], f"<u{row['width']}")
    return [payload[int(s) : int(s) + int(n)] if ok else None for s, n, ok in zip(starts, lengths, held)]


class _Pieces(dict):
    """Ids by piece; looking up a piece that is not known notes it and gives None."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.new.append(piece)


class Encoder:
    """A tokenizer that keeps the ids of pieces it has seen; a worker process keeps it between tasks.

    A text's pieces are what lies between single spaces and newlines.  With ``spaced`` the tokenizer
    keeps white space: a piece takes the space before it, which a byte-level pattern joins to the word
    that follows, or the newline before it.  Where more white space follows a space or newline, or the
    text ends with one, the tokenizer gets the whole text.  Without ``spaced`` it drops white space and
    treats words alone.  Marks at the end of a piece, after a letter, have ids of their own.  So ids are
    always those of the whole text.  New pieces are encoded many to a string.  Not more than about
    MOST pieces are kept.
    """

    MOST = 1_500_000
    #: A character with an id of its own, which parts new pieces where white space is dropped.
    MARK = "\x01"
    ENDS = ".,;:!?&$*%"
    kept: dict[str, "Encoder"] = {}

    def __init__(self, path: str, spaced: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a text that holds one of these goes to the tokenizer as it is
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.spaced = spaced
        self.end_ids = {"": b""}
        self.known = _Pieces()
        if spaced:  # in this vocabulary a character stands for a byte
            self.bytes_of = np.zeros(self.tokenizer.get_vocab_size(), "i8")
            for token, i in self.tokenizer.get_vocab().items():
                self.bytes_of[i] = len(token)
        else:
            (self.mark,) = self.ids(self.MARK)
            self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.closes[i] = token.endswith("</w>")

    @classmethod
    def of(cls, path: str, spaced: bool) -> "Encoder":
        if path not in cls.kept:
            cls.kept[path] = cls(path, spaced)
        return cls.kept[path]

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    @staticmethod
    def parts(every: list[str]) -> Iterator[list[str]]:
        return (every[at : at + 20_000] for at in range(0, len(every), 20_000))

    def joined(self, strings: list[str]) -> np.ndarray:
        """Ids of some strings, end to end."""
        return np.concatenate([np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)])

    def keep(self, pieces: list[str], ids: np.ndarray, last: np.ndarray) -> None:
        """Makes pieces known; ``last`` is where each one's ids end."""
        raw, lo = ids.tobytes(), 0
        for x, hi in zip(pieces, (4 * last).tolist()):
            self.known[x] = raw[lo:hi]
            lo = hi

    def learn(self, new: set[str]) -> None:
        """Encodes pieces, joined to long strings, and takes the ids apart again.

        A piece that needs the whole text becomes False.
        """
        known, ends = self.known, self.end_ids
        plain: set[str] = set()
        words: set[str] = set()
        ended = []
        for x in new:
            if self.spaced and (not x or x[x[0] == "\n" :][:1].isspace() or x == "\n"):
                known[x] = False
                continue
            if not self.spaced and self.MARK in x:
                known[x] = np.array(self.ids(x), "<u4").tobytes()
                continue
            core = x.rstrip(self.ENDS)
            marks = x[len(core) :]
            if not self.spaced and core.isalpha() and (core.isascii() or max(core) < "\u0100"):
                core = core.lower()  # as the tokenizer has it; one word, which one token ends
                if core not in known:
                    words.add(core)
                if core != x:
                    ended.append((x, core, marks))
            elif marks and core[-1:].lower().isalpha():
                ended.append((x, core, marks))
                if core not in known:
                    plain.add(core)
            else:
                plain.add(x)
        for some in self.parts(list(words)):
            ids = self.joined([" ".join(some[k : k + 200]) for k in range(0, len(some), 200)])
            last = np.flatnonzero(self.closes[ids]) + 1
            if len(last) == len(some) and last[-1] == len(ids):
                self.keep(some, ids, last)
            else:
                plain.update(some)
        for some in self.parts(list(plain)):
            if self.spaced:
                pieces = [x if x[0] == "\n" else " " + x for x in some]
                ids = self.joined(["".join(pieces[k : k + 200]) for k in range(0, len(some), 200)])
                sizes = np.fromiter((len(x) if x.isascii() else len(x.encode()) for x in pieces), "i8", len(pieces))
                last = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes)) + 1
            else:  # a mark before each piece
                ids = self.joined([f" {self.MARK} " + f" {self.MARK} ".join(some[k : k + 200]) for k in range(0, len(some), 200)])
                at = np.flatnonzero(ids == self.mark)
                ids = np.delete(ids, at)
                last = np.r_[(at - np.arange(len(at)))[1:], len(ids)]
            if len(last) != len(some) or last[-1] != len(ids):
                raise RuntimeError("pieces and ids don't match")
            self.keep(some, ids, last)
        for x, core, marks in ended:
            if marks not in ends:
                if len(ends) > 100_000:
                    ends.clear()
                    ends[""] = b""
                ends[marks] = np.array(self.ids(marks), "<u4").tobytes()
            known[x] = known[core] + ends[marks]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers."""
        known = self.known
        if len(known) > self.MOST:
            known.clear()
        new = known.new
        new.clear()
        ids_of = known.__getitem__
        heads: list[bytes] = []
        if self.spaced:  # what comes before the first space or newline
            firsts = [t[: min((at for at in (t.find(" "), t.find("\n")) if at >= 0), default=len(t))] for t in texts]
            heads = [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(firsts, add_special_tokens=False)]
        rows = []
        for t in texts:
            before = len(new)
            if any(x in t for x in self.added):
                rows.append(([False], before, before))
                continue
            parts = t.replace("\n", " \n" if self.spaced else " ").split(" ")
            found = list(map(ids_of, parts[1:] if self.spaced else parts))
            rows.append((found, before, len(new)))
        noted = new[:]
        self.learn(set(noted))
        out = []
        for k, (found, lo, hi) in enumerate(rows):
            at = -1
            for piece in noted[lo:hi]:
                at = found.index(None, at + 1)
                found[at] = known[piece]
            try:
                out.append((heads[k] if heads else b"") + b"".join(found))
            except TypeError:  # False: a piece without ids of its own
                out.append(np.array(self.ids(texts[k]), "<u4").tobytes())
        for piece in noted:
            if len(piece) > 200:
                known.pop(piece, None)
        return out


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes the texts in ascending order of id and writes the dataset to ``path``.

    One range shuffle of the texts; then each task encodes its range in order and fills shards of
    about SHARD_IDS ids, of which a task holds one at a time.
    """
    spark = docs.sparkSession
    end = np.array([end_id], "<u4").tobytes()

    def shards(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder.of(tokenizer_path, spaced=True)
        part, k, held, ids, total = TaskContext.get().partitionId(), 0, [], [], 0
        previous, occurrence = object(), -1

        def full():
            keys = np.array(ids, KEY)
            return pa.RecordBatch.from_pylist([pack_shard(part << 32 | k, keys, held)], schema=arrow)

        for b in batches:
            for at in range(0, b.num_rows, 1000):
                some = b.slice(at, 1000)
                for key, raw in zip(some.column(0).to_pylist(), encoder([t or "" for t in some.column(1).to_pylist()])):
                    document = np.frombuffer(raw + end, "<u4")
                    if held and total + len(document) > SHARD_IDS:
                        yield full()
                        k, held, ids, total, previous = k + 1, [], [], 0, object()
                    occurrence = occurrence + 1 if key == previous else 0
                    previous = key
                    held.append(document)
                    ids.append((key or 0, key is None, occurrence))
                    total += len(document)
        if held:
            yield full()

    arrow = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in SCHEMA.split(", "))])
    ordered = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # texts of one id, or of none, may fill many tasks: how they begin and a number part them
    keys = ["id", F.substring(F.coalesce("text", F.lit("")), 1, 64), F.monotonically_increasing_id()]
    ordered = ordered.repartitionByRange(partitions(spark), *keys).sortWithinPartitions("id", F.coalesce("text", F.lit("")))
    ordered.mapInArrow(shards, SCHEMA).write.mode("overwrite").parquet(path)


def scan(store: DataFrame) -> DataFrame:
    """Every document of a dataset, through the index: ``doc_id, occurrence, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it.  Only a row of numbers for each shard is
    summed in order, and joined back to rows of numbers; payloads are read where they lie.
    """

    def rows(batches):
        for b in batches:
            for row in b.to_pylist():
                keys = np.frombuffer(row["keys"], KEY)
                found = read_keys(row, keys)
                if any(x is None for x in found):
                    raise RuntimeError(f"shard {row['shard']}: a key is not in its index")
                sizes = np.array([len(x) for x in found], "i8")
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in found]
                yield pa.record_batch({"shard": np.full(len(keys), row["shard"], "i8"), "doc_id": pa.array(keys["id"], mask=keys["null"] > 0), "occurrence": keys["occurrence"].astype("i8"), "within": np.cumsum(sizes) - sizes, "n_tokens": sizes, "ids_crc32": np.array(crc, "i8")})

    each = store.mapInArrow(rows, "shard long, doc_id long, occurrence long, within long, n_tokens long, ids_crc32 long")
    # two levels: sums of the shards that one task wrote, then of the tasks
    sizes = store.select("shard", F.shiftright("shard", 32).alias("part"), "n_ids")
    tasks = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    bases = sizes.join(tasks, "part").select("shard", (F.col("before") + F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_ids")).alias("base"))
    return each.join(bases, "shard").select("doc_id", "occurrence", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def lookup(store: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyed access: ``(shard, doc_id, occurrence, ids)`` for every document of the wanted ids (``ids`` as uint32).

    Shards are chosen by their key ranges; in a shard each occurrence costs one bucket and one slot.
    Payloads are read only of shards chosen; where the choice is small, Spark broadcasts it and they
    stay where they lie.  Ids that are null or that no shard holds get no row.
    """
    wanted = keys.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    ranges = store.where("first_key is not null").select("shard", "first_key", "last_key")
    chosen = wanted.join(ranges, F.col("doc_id").between(F.col("first_key"), F.col("last_key"))).groupBy("shard").agg(F.collect_list("doc_id").alias("wanted"))

    def find(batches):
        for b in batches:
            for row in b.to_pylist():
                ids, k = np.array(row["wanted"], "i8"), 0
                while len(ids):  # occurrence by occurrence, until a key has no more
                    keys = np.zeros(len(ids), KEY)
                    keys["id"], keys["occurrence"] = ids, k
                    found = read_keys(row, keys)
                    has = np.array([x is not None for x in found])
                    if has.any():
                        yield pa.record_batch({"shard": np.full(has.sum(), row["shard"], "i8"), "doc_id": ids[has], "occurrence": np.full(has.sum(), k, "i8"), "ids": pa.array([x.astype("<u4").tobytes() for x in found if x is not None], pa.binary())})
                    ids, k = ids[has], k + 1

    hit = store.join(chosen, "shard").select("shard", "n_docs", "width", "displace", "fingerprints", "starts", "lengths", "payload", "wanted")
    return hit.mapInArrow(find, "shard long, doc_id long, occurrence long, ids binary")


def op7_token_store(spark, sf_dir):
    """Encodes ``documents``, writes the dataset in the shared folder, and reads it back."""
    import public_tokenizers as P

    path = new_path(spark, "token-store")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, P.path("byte_bpe_50k.json"), end_id=2)
    return scan(spark.read.parquet(path)).select("doc_id", "start", "n_tokens", "ids_crc32")
