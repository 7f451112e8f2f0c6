"""Exact n-gram Jaccard join with set-relation skipping (operator 6).

Documents whose shingle sets have a Jaccard similarity of at least ``percent`` / 100 are linked; the
result has each document's component.  Shingles are hashed to 64 bits, sets are told apart by a 64-bit
hash of their own.

1. One pass describes every document: size of its set, the set's hash, a parity sketch (each of
   SKETCH bits is the parity of the shingles hashed there) and its LOW least shingles by another hash.
   Two sketches differ in no more bits than their sets differ in shingles, so a sketch proves most
   unlike sets unlike, and never a like one.  Equal sets are one set from here on.
2. Set relations: among the sets that share a least shingle with a set, or with such a one, the
   foremost (most copies, then by hash) that sketches estimate to be like it is its head.  A member is
   kept as its difference to its head.  Two members x, y of one head have |x - y| = |dx| + |dy| - 2 |dx
   and dy in common|, so a member's answers derive from the differences: those near enough to the
   group's centre are linked to it without looking at any pair, and only the others need partners,
   with which their differences must share shingles.
3. Index lists: the first shingles, from rare to frequent by counts over all documents (kept for SLOTS
   hash slots, a table of fixed size), of every set; and in the same way the first shingles of the
   differences of members that step 2 leaves open, with lists of their own for each head.
4. A list stands in order of what its sets ask of a partner.  A set's position in the list bounds what
   it can still share, so its partners are one stretch of the list, and the rest is skipped; lists of
   one head or one component are skipped whole.  Pairs of one head (their differences' lists tell),
   of one component, or that sketches prove unlike go too.  What remains is verified exactly, the
   likeliest pair of any two components first, as it may decide the others.

A list of more than BLOCK sets is dealt in blocks, and each pair of blocks is a key of its own; a head
of more than GROUP members meets them in parts.  No pair is left out: each is skipped only where a
bound or an earlier answer decides it.

Defined results: null or empty texts, and those without words, have n_shingles 0 and are linked with
nothing; documents of equal id stay rows of their own; a null id is never a component's name unless
nothing else is; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, fixed_binary, from_fixed, key_runs, mix64, partitions, release, starts_of, stored

SLOTS_LOG = 17
SKETCH = 1024
BLOCK = 1024
LOW = 4
GROUP = 2000
#: Sketches that differ in more bits tell nothing of likeness; sets that differ in more than this part of their sizes are unlike.
SATURATED, LIKE = 460, 0.55
#: Sets that a task remembers, so that copies in it are handled once; more are handled later.
SEEN = 200_000
#: Sets of more shingles take whole sketches into the sweep, others folded ones.
LONG = 512
BLOOM_BITS = 1 << 23
PIECE = 1 << 18

#: White space of words, by the contract: space and the characters 9 to 13.
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words end."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]  # of bytes, only A-Z change
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", "u1")
    inside = ~_GAP[data]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    doc_ends = np.cumsum([len(r) + 1 for r in raw])
    ends = np.searchsorted(starts, doc_ends, side="right")
    if not len(starts):
        return np.empty(0, "u8"), ends
    stops = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    lengths = stops - starts
    at = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _ODD[0]))
    at[~inside] = 0
    sums = np.where(inside, (data.astype("u8") + np.uint64(1)) * powers[at], np.uint64(0))
    return mix64(np.add.reduceat(sums, starts) ^ (lengths.astype("u8") * _ODD[1])), ends


def shingle_sets(texts: list[str | None], words: int = 3) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes; a shorter text's words are one shingle."""
    w, ends = word_hashes(texts)
    out = []
    rolled = np.zeros(max(len(w) - words + 1, 0), "u8")
    for k in range(words):
        rolled = (rolled ^ w[k : len(w) - words + 1 + k]) * _ODD[k % 3] + np.uint64(k + 1) if len(rolled) else rolled
    rolled = mix64(rolled)
    lo = 0
    for hi in ends.tolist():
        if hi - lo >= words:
            out.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            h = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for x in w[lo:hi]:
                    h = (h ^ x) * _ODD[1] + np.uint64(77)
            out.append(mix64(np.array([h], "u8")))
        else:
            out.append(np.empty(0, "u8"))
        lo = hi
    return out


def sets_of(batches, words: int):
    """Record batches of (any id, text) as pieces of whole texts: (rows, sets)."""
    for b in batches:
        texts = b.column(b.num_columns - 1)
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0))
        lo = 0
        while lo < b.num_rows:
            hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), PIECE)))
            yield b.slice(lo, hi - lo), shingle_sets(texts.slice(lo, hi - lo).to_pylist(), words)
            lo = hi


def set_id(s: np.ndarray) -> int:
    """The hash of a whole set."""
    if not len(s):
        return 0
    m = mix64(s + _ODD[2])
    both = np.array([np.bitwise_xor.reduce(m)]) * _ODD[0] ^ m.sum(dtype="u8") ^ np.uint64(len(s))
    return int(mix64(both).view("i8")[0])


def sketch(s: np.ndarray) -> np.ndarray:
    return np.packbits((np.bincount((s * _ODD[1] >> np.uint64(40)).astype("i8") % SKETCH, minlength=SKETCH) & 1).astype(bool))


def brief(bits: np.ndarray) -> np.ndarray:
    """Packed sketches folded to a quarter: bits of equal place add up, so they still differ in no more bits than the sets."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), 4, -1), axis=1)


def unfolded(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded sketches of all rows, whole sketches (zero where a row has only a folded one), and which rows have whole ones."""
    raw = column.to_pylist()
    long = np.array([len(x) > SKETCH // 32 for x in raw], bool)
    whole, folded = np.zeros((len(raw), SKETCH // 8), "u1"), np.zeros((len(raw), SKETCH // 32), "u1")
    if long.any():
        whole[long] = np.frombuffer(b"".join(x for x in raw if len(x) > SKETCH // 32), "u1").reshape(-1, SKETCH // 8)
        folded[long] = brief(whole[long])
    if not long.all():
        folded[~long] = np.frombuffer(b"".join(x for x in raw if len(x) <= SKETCH // 32), "u1").reshape(-1, SKETCH // 32)
    return folded.view("u8"), whole.view("u8"), long


def fine_sketch(s: np.ndarray) -> bytes:
    """A parity sketch of at least a bit for each shingle; half of one folded on the other is the sketch of half its size."""
    size = 1 << max(10, int(len(s) - 1).bit_length())
    return np.packbits((np.bincount((mix64(s) % np.uint64(size)).astype("i8"), minlength=size) & 1).astype(bool)).tobytes()


def fine_differ(x: bytes, y: bytes) -> int:
    a, b = np.frombuffer(x, "u1"), np.frombuffer(y, "u1")
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum(dtype="i8"))


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of n with any set that it is linked to."""
    return -(-n * percent // 100)


def difference(x: np.ndarray, head: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """Shingles of just one of two sets: first those that the head lacks, each from rare to frequent."""
    both = np.sort(np.concatenate([x, head]))
    twice = np.r_[False, both[1:] == both[:-1]]
    own = both[~(twice | np.r_[twice[1:], False])]
    at = np.minimum(np.searchsorted(head, own), len(head) - 1)
    return own[np.lexsort((own, frequency[own >> np.uint64(64 - SLOTS_LOG)], head[at] == own))]


def partnered(token: np.ndarray, n: np.ndarray, dn: np.ndarray, pos: np.ndarray, delta: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of index lists, sorted by token, some other row of their list may be linked to, by what both ask and can share.

    The first and last list may go on in other batches, so all of their rows stay.
    """
    up, down = 100 + percent, 100 - percent
    n, dn, pos = n.astype("i8"), dn.astype("i8"), pos.astype("i8")
    asks = np.where(delta, up * dn - down * n, 2 * percent * n)
    shares = 2 * up * (dn - pos) - asks

    def of_others(x):
        """The least of the other rows of the list."""
        order = np.lexsort((x, token))
        lo = starts_of(token[order])
        size = np.diff(np.r_[lo, len(x)])
        far = np.iinfo("i8").max
        least = np.repeat(x[order][lo], size)
        second = np.repeat(np.where(size > 1, x[order][np.minimum(lo + 1, len(x) - 1)], far), size)
        out = np.empty(len(x), "i8")
        own = np.zeros(len(x), bool)
        own[lo] = True
        out[order] = np.where(own, second, least)
        return out

    keep = (of_others(asks) <= shares) & (asks <= -of_others(-shares))
    return keep | (token == token[0]) | (token == token[-1])


def join(docs: DataFrame, percent: int = 90, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id)``, one for each row of ``docs``."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_parts = partitions(spark)
    up, down = 100 + percent, 100 - percent

    def describe(batches):
        total = np.zeros(1 << SLOTS_LOG, "i8")
        seen: set[int] = set()
        for b, sets in sets_of(batches, words):
            ids = [set_id(s) for s in sets]
            bits: list[bytes | None] = [None] * len(sets)
            briefs, fine, low = bits[:], bits[:], bits[:]
            for i, (s, key) in enumerate(zip(sets, ids)):
                if len(s) and key not in seen:  # copies in one task are described once
                    if len(seen) < SEEN:
                        seen.add(key)
                    own = sketch(s)
                    bits[i], briefs[i] = own.tobytes(), brief(own[None])[0].tobytes()
                    fine[i] = fine_sketch(s) if len(s) > LONG else None
                    mixed = mix64(s ^ _ODD[1])
                    low[i] = s[np.argpartition(mixed, LOW - 1)[:LOW] if len(s) > LOW else slice(None)].view("i8").tolist()
            yield pa.record_batch({"doc_id": b.column(0), "n": pa.array([len(s) for s in sets], pa.int64()), "sid": pa.array(ids, pa.int64()), "sketch": pa.array(bits, pa.binary()), "brief": pa.array(briefs, pa.binary()), "fine": pa.array(fine, pa.binary()), "low": pa.array(low, pa.list_(pa.int64())), "slot": np.zeros(len(sets), bool)})
            total += np.bincount(np.concatenate(sets) >> np.uint64(64 - SLOTS_LOG), minlength=len(total))
        some = np.flatnonzero(total)
        empty = pa.nulls(len(some), pa.binary())
        yield pa.record_batch({"doc_id": some, "n": total[some], "sid": np.zeros(len(some), "i8"), "sketch": empty, "brief": empty, "fine": empty, "low": pa.nulls(len(some), pa.list_(pa.int64())), "slot": np.ones(len(some), bool)})

    # one pass: a row for each document, and a task's counts of slots as rows of their own
    passed = stored(source.mapInArrow(describe, "doc_id long, n long, sid long, sketch binary, brief binary, fine binary, low array<long>, slot boolean"))
    described = passed.where("not slot").select("doc_id", "n", "sid")
    known = passed.where("not slot and n > 0").groupBy("sid")
    sets = stored(known.agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies"), *[F.first(k, True).alias(k) for k in ("sketch", "brief", "fine", "low")]))
    slots = passed.where("slot").groupBy(F.col("doc_id").alias("slot")).agg(F.sum("n").alias("n")).toArrow()  # SLOTS rows at most
    frequency = np.zeros(1 << SLOTS_LOG, "i8")
    frequency[slots.column("slot").to_numpy()] = slots.column("n").to_numpy()
    shared = spark.sparkContext.broadcast(frequency)
    facts = lambda a, n, s: sets.select(F.col("sid").alias(a), F.col("n").alias(n), F.col("sketch").alias(s))

    def apart(batches):
        """Adds the number of differing sketch bits to pairs."""
        for b in batches:
            if b.num_rows:
                x, y = from_fixed(b.column("sa"), "u8"), from_fixed(b.column("sb"), "u8")
                yield pa.record_batch({k: b.column(k) for k in ("a", "b", "na", "nb")} | {"differ": np.bitwise_count(x ^ y).sum(1).astype("i8")})

    def sketched(pairs: DataFrame) -> DataFrame:
        """Pairs ``(a, b)`` with their sizes and the number of differing bits of their sketches."""
        both = pairs.select("a", "b").join(facts("a", "na", "sa"), "a").join(facts("b", "nb", "sb"), "b")
        return both.mapInArrow(apart, "a long, b long, na long, nb long, differ long")

    def finer(batches):
        """Of pairs of long sets those that sketches in proportion to the sets leave open."""
        for b in batches:
            differ = np.array([fine_differ(x, y) for x, y in zip(b.column("fa").to_pylist(), b.column("fb").to_pylist())], "i8")
            yield b.select(["a", "b", "na", "nb", "differ"]).filter(pa.array(up * differ <= down * (b.column("na").to_numpy() + b.column("nb").to_numpy())))

    def opened(pairs: DataFrame) -> DataFrame:
        """Pairs that sketches of all sizes leave open."""
        left = sketched(pairs).where(down * (F.col("na") + F.col("nb")) >= up * F.col("differ"))
        long = (F.col("na") > LONG) & (F.col("nb") > LONG)
        left = stored(left)
        fine = lambda k: sets.select(F.col("sid").alias(k), F.col("fine").alias(f"f{k}"))
        both = left.where(long).join(fine("a"), "a").join(fine("b"), "b").select("a", "b", "na", "nb", "differ", "fa", "fb")
        return stored(left.where(~long).union(both.mapInArrow(finer, "a long, b long, na long, nb long, differ long")).select("a", "b", "differ"))

    def fetch(wanted: DataFrame) -> DataFrame:
        """The sets named by ``wanted(sid)``: ``sid, items`` and the other columns of ``wanted``, for each of its rows."""

        def bits(batches):
            m = np.zeros(BLOOM_BITS, bool)
            for b in batches:
                h = mix64(b.column(0).to_numpy().view("u8"))
                m[(h % np.uint64(BLOOM_BITS)).astype("i8")] = True
                m[(h // np.uint64(BLOOM_BITS) % np.uint64(BLOOM_BITS)).astype("i8")] = True
            yield pa.record_batch({"m": pa.array([np.packbits(m).tobytes()], pa.binary())})

        # a filter of fixed size tells most sets that aren't wanted; it only saves their shuffle
        filled = np.zeros(BLOOM_BITS // 8, "u1")
        for row in wanted.select("sid").coalesce(8).mapInArrow(bits, "m binary").toLocalIterator():
            filled |= np.frombuffer(row["m"], "u1")
        bloom = spark.sparkContext.broadcast(filled)

        def held(batches):
            seen: set[int] = set()
            mask = np.unpackbits(bloom.value).astype(bool)
            for _, found in sets_of(batches, words):
                ids = np.array([set_id(s) for s in found], "i8")
                h = mix64(ids.view("u8"))
                some = mask[(h % np.uint64(BLOOM_BITS)).astype("i8")] & mask[(h // np.uint64(BLOOM_BITS) % np.uint64(BLOOM_BITS)).astype("i8")]
                take = []
                for i in np.flatnonzero(some):
                    if len(found[i]) and ids[i] not in seen:
                        if len(seen) < SEEN:
                            seen.add(ids[i])
                        take.append(i)
                if take:
                    yield pa.record_batch({"sid": ids[take], "items": pa.array([found[i].tobytes() for i in take], pa.binary())})

        return stored(source.mapInArrow(held, "sid long, items binary").groupBy("sid").agg(F.first("items").alias("items")).join(wanted, "sid"))

    def verified(pairs: DataFrame, items: DataFrame) -> DataFrame:
        """Of pairs of sets those that are linked, by the sets themselves."""

        def check(batches):
            for b in batches:
                ok = []
                for x, y in zip(b.column("xs").to_pylist(), b.column("ys").to_pylist()):
                    x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        left = pairs.select("a", "b").join(items.select(F.col("sid").alias("a"), F.col("items").alias("xs")), "a")
        both = left.join(items.select(F.col("sid").alias("b"), F.col("items").alias("ys")), "b").select("a", "b", "xs", "ys")
        return stored(both.mapInArrow(check, "a long, b long"))

    # a head for each set: of the sets that share one of its least shingles, at one remove or two, the foremost
    rank = -F.shiftleft("copies", 32) + F.pmod(F.xxhash64("sid"), F.lit(1 << 32))
    lows = stored(sets.select("sid", rank.alias("rank"), F.explode("low").alias("token")))
    foremost = [F.min_by("head", "rank").alias("head"), F.min("rank").alias("rank")]
    once = lows.groupBy("token").agg(F.min_by("sid", "rank").alias("head"), F.min("rank").alias("rank"), F.count("*").alias("k")).where("k > 1").drop("k")
    near = lows.select("sid", "token").join(once, "token")
    own = near.groupBy("sid").agg(*foremost)
    far = lows.select("sid", "token").join(own, "sid").groupBy("token").agg(*foremost)
    far = lows.select("sid", "token").join(far, "token").groupBy("sid").agg(*foremost)
    heads = stored(near.select("sid", "head", "rank").union(far.select("sid", "head", "rank")).where("sid <> head").distinct())
    # what two sets differ in, estimated from their sketches; a head of little likeness is none
    estimate = -F.log1p(-2 * F.col("differ") / SKETCH) * (SKETCH / 2)
    like = sketched(heads.select(F.col("sid").alias("a"), F.col("head").alias("b"))).where(F.col("differ") <= SATURATED).where(estimate <= LIKE * (F.col("na") + F.col("nb")))
    lead = like.select(F.col("a").alias("sid"), F.col("b").alias("head")).join(heads, ["sid", "head"])
    lead = stored(lead.groupBy("sid").agg(F.min_by("head", "rank").alias("head")))
    for used in (lows, heads):
        release(used)

    # members as differences to their head
    def differences(batches):
        for b in batches:
            own = [difference(np.frombuffer(x, "u8"), np.frombuffer(y, "u8"), shared.value) for x, y in zip(b.column("items").to_pylist(), b.column("top").to_pylist())]
            yield pa.record_batch({"head": b.column("head"), "sid": b.column("sid"), "n": (pa.compute.binary_length(b.column("items")).to_numpy() // 8).astype("i8"), "dn": np.array([len(x) for x in own], "i8"), "own": pa.array([x.tobytes() for x in own], pa.binary())})

    groups = lead.groupBy("head").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("salts"))
    salted = lead.join(groups, "head").select("sid", "head", F.pmod(F.xxhash64("sid"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("first"))
    items = fetch(salted.union(groups.select("head", "head", "salts", F.lit(True))))
    members = items.where("not first").select("head", "salt", "sid", "items")
    tops = items.where("first").select("head", F.explode(F.sequence(F.lit(0), F.col("salt") - 1)).alias("salt"), F.col("items").alias("top"))
    deltas = stored(members.join(tops, ["head", "salt"]).mapInArrow(differences, "head long, sid long, n long, dn long, own binary"))
    release(items)
    excess = lambda dn: up * dn - down * F.col("n")  # noqa: E731  two members are linked iff their excesses are at most 2 * up * (what their differences share)
    weighed = deltas.select("head", "sid", excess(F.col("dn")).alias("w")).union(groups.join(facts("head", "n", "_s"), "head").select("head", F.col("head").alias("sid"), excess(F.lit(0)).alias("w")))
    centre = weighed.groupBy("head").agg(F.min_by("sid", "w").alias("m"), F.min("w").alias("wm"))
    placed = weighed.join(centre, "head")
    links = stored(placed.where("w <= -wm and sid <> m").select(F.col("m").alias("a"), F.col("sid").alias("b")))
    outer = placed.where("w > -wm").groupBy("head", "wm").agg(F.min("w").alias("wf"))
    parts = components(links)
    marks = stored(sets.select("sid").join(lead, "sid", "left").join(parts, F.col("sid") == F.col("node"), "left").select("sid", F.coalesce("head", "sid").alias("head"), F.coalesce("component", "sid").alias("part")))

    # index lists: shingles of sets, and for members that their head's answers don't decide, of their differences
    def prefixes(batches):
        seen: set[int] = set()
        for _, found in sets_of(batches, words):
            token, sid, n, pos = [], [], [], []
            for s in found:
                if not len(s) or (key := set_id(s)) in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(key)
                k = len(s) - int(needed(np.array(len(s)), percent)) + 1
                token.append(s[np.lexsort((s, shared.value[s >> np.uint64(64 - SLOTS_LOG)]))[:k]])
                sid.append(np.full(k, key, "i8"))
                n.append(np.full(k, len(s), "i4"))
                pos.append(np.arange(k, dtype="i4"))
            if token:
                size = np.concatenate(n)
                yield pa.record_batch({"token": np.concatenate(token).view("i8"), "sid": np.concatenate(sid), "n": size, "dn": size, "pos": np.concatenate(pos), "delta": np.zeros(len(size), bool), "more": np.zeros(len(size), bool)})

    def partial(batches):
        for b in batches:
            col = {k: b.column(k).to_numpy() for k in ("head", "sid", "n", "dn", "wm", "wf")}
            w = up * col["dn"] - down * col["n"]
            partner = np.where(w > -col["wm"], col["wm"], col["wf"])  # the least excess of those it may be linked to
            k = np.maximum(col["dn"] - np.maximum(1, -(-(w + partner) // (2 * up))) + 1, 0)
            if not k.sum():
                continue
            token = np.concatenate([np.frombuffer(x, "u8")[:m] for x, m in zip(b.column("own").to_pylist(), k.tolist())])
            token = mix64(token ^ np.repeat(mix64(col["head"].view("u8")), k))
            pos = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            yield pa.record_batch({"token": token.view("i8"), "sid": np.repeat(col["sid"], k), "n": np.repeat(col["n"], k).astype("i4"), "dn": np.repeat(col["dn"], k).astype("i4"), "pos": pos.astype("i4"), "delta": np.ones(len(pos), bool), "more": np.zeros(len(pos), bool)})

    def listed(batches):
        """Rows of shingles that two sets have, each set once; only one row is held over."""
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None and not b.num_rows:
                continue
            new = None if b is None else pa.Table.from_arrays(b.columns, names=b.schema.names)
            t = held if new is None else new if held is None else pa.concat_tables([held, new]).combine_chunks()
            if t is None:
                return
            token, sid = t.column("token").to_numpy(), t.column("sid").to_numpy()
            same = token[1:] == token[:-1]
            fresh = np.r_[True, ~(same & (sid[1:] == sid[:-1]))]
            other = same & (sid[1:] != sid[:-1])
            # whether the row before or after is of the same shingle and another set; a held row's look back is kept in "more"
            back = np.r_[False, other] | t.column("more").to_numpy()
            ahead = np.r_[other, False]
            # copies of a row share what the last of them sees ahead
            group = np.cumsum(fresh) - 1
            any_of = np.zeros(group[-1] + 1, bool)
            np.logical_or.at(any_of, group, back | ahead)
            first = np.flatnonzero(fresh)
            last = group[-1] if b is not None else len(first)  # the last set may go on in the next batch
            take = first[:last][any_of[:last]]
            if len(take):
                take = take[partnered(token[take], *(t.column(k).to_numpy()[take] for k in ("n", "dn", "pos", "delta")), percent)]
            if len(take):
                yield t.take(pa.array(take)).drop_columns(["more"]).to_batches()[0]
            if b is not None:
                held = t.slice(int(first[-1]), 1)
                held = held.set_column(held.schema.get_field_index("more"), "more", pa.array([bool(any_of[-1])]))

    row = "token long, sid long, n int, dn int, pos int, delta boolean"
    index = source.mapInArrow(prefixes, row + ", more boolean").union(deltas.join(outer, "head").select("head", "sid", "n", "dn", "wm", "wf", "own").mapInArrow(partial, row + ", more boolean"))
    index = index.repartition(n_parts, "token").sortWithinPartitions("token", "sid").mapInArrow(listed, row)
    # w: what a set asks of a partner; cap: the most that a partner may ask which it meets in this list, by its position
    weight = F.when(F.col("delta"), up * F.col("dn").cast("long") - down * F.col("n")).otherwise(2 * percent * F.col("n").cast("long"))
    whole = stored(index.join(marks, "sid").select("token", "sid", "n", "part", F.when(F.col("delta"), F.col("sid")).otherwise(F.col("head")).alias("head"), weight.alias("w"), (2 * up * (F.col("dn") - F.col("pos")).cast("long") - weight).alias("cap")))
    # a list whose sets have one component or one head has nothing to tell
    lists = whole.groupBy("token").agg(*[f(k).alias(f"{k}_{f.__name__}") for k in ("part", "head") for f in (F.min, F.max)], F.min("w").alias("least"), F.count("*").alias("size"))
    lists = lists.where("part_min <> part_max and head_min <> head_max").select("token", "least", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    index = whole.join(lists, "token").where("cap >= least").join(sets.select("sid", F.when(F.col("n") > LONG, F.col("sketch")).otherwise(F.col("brief")).alias("bits")), "sid")
    index = index.withColumn("block", F.pmod(F.xxhash64("sid", F.lit(9)), F.col("blocks")).cast("int"))
    deal = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("first"), F.greatest("block", k).alias("second"))))
    index = index.withColumn("_p", deal).select("token", "_p.first", "_p.second", "block", "sid", "n", "w", "cap", "part", "head", "bits")

    def sweep(batches):
        for run in key_runs(batches, ["token", "first", "second"], 8192):
            size = run.num_rows
            col = lambda k: run.column(k).to_numpy()
            sid, n, w, cap, part, head, block = (col(k).astype("i8") for k in ("sid", "n", "w", "cap", "part", "head", "block"))
            group = np.repeat(np.arange(len(s := starts_of(col("token"), col("first"), col("second")))), np.diff(np.r_[s, size]))
            cross = col("first") != col("second")
            folded, fine, long = unfolded(run.column("bits"))
            met = []
            alive = np.arange(size)
            for step in range(1, size):
                alive = alive[alive + step < size]
                # rows stand by what they ask: beyond a set's cap, the rest of the list is skipped
                alive = alive[(group[alive] == group[alive + step]) & (w[alive + step] <= cap[alive])]
                if not len(alive):
                    break
                i, j = alive, alive + step
                ok = (w[i] <= cap[j]) & (part[i] != part[j]) & (head[i] != head[j]) & (sid[i] != sid[j]) & ~(cross[i] & (block[i] == block[j]))
                i, j = i[ok], j[ok]
                most = down * (n[i] + n[j])
                ok = up * np.bitwise_count(folded[i] ^ folded[j]).sum(1).astype("i8") <= most
                both = np.flatnonzero(ok & long[i] & long[j])
                ok[both] = up * np.bitwise_count(fine[i[both]] ^ fine[j[both]]).sum(1).astype("i8") <= most[both]
                if ok.any():
                    met.append(np.stack([np.minimum(sid[i], sid[j])[ok], np.maximum(sid[i], sid[j])[ok]], 1))
            if met:
                pairs = np.unique(np.concatenate(met), axis=0)
                yield pa.record_batch({"a": np.ascontiguousarray(pairs[:, 0]), "b": np.ascontiguousarray(pairs[:, 1])})

    open_pairs = index.repartition(n_parts, "token", "first", "second").sortWithinPartitions("token", "first", "second", "w", "sid").mapInArrow(sweep, "a long, b long")
    left = opened(open_pairs.distinct())
    for used in (whole, deltas):
        release(used)
    if not left.isEmpty():
        items = fetch(left.select(F.col("a").alias("sid")).union(left.select("b")).distinct())
        for turn in range(2):
            # the likeliest pair of two components first: most others derive their answers from it
            named = left.join(parts.toDF("a", "pa"), "a", "left").join(parts.toDF("b", "pb"), "b", "left")
            left = stored(named.select("a", "b", "differ", F.coalesce("pa", "a").alias("pa"), F.coalesce("pb", "b").alias("pb")).where("pa <> pb"))
            best = left
            if turn < 1:
                best = stored(left.groupBy(F.least("pa", "pb"), F.greatest("pa", "pb")).agg(F.min_by(F.struct("a", "b"), F.struct("differ", "a", "b")).alias("x")).select("x.a", "x.b"))
                left = stored(left.join(best, ["a", "b"], "left_anti").select("a", "b", "differ"))
            links = links.union(verified(best, items))
            if left.isEmpty():
                break
            if turn < 1:
                parts = components(links)

    # components by documents: a set's name is its smallest document
    rep = sets.select("sid", "rep").where("rep is not null")
    edges = links.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    parts = components(edges)
    out = described.join(sets.select(F.col("sid").alias("_sid"), "rep"), F.col("sid") == F.col("_sid"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component", "rep", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op6_jaccard(spark, sf_dir):
    """Links among all ``documents`` whose 3-word shingle sets have a similarity of 0.9 or more."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
