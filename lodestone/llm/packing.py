"""Best-fit packing of token sequences under several capacities (operator 8).

A sequence has a vector of capacities: tokens, documents and attention cost (the sum of squared piece
lengths).  Pieces go in from the costliest to the cheapest.  Each looks at the open sequences that can
hold it in every dimension and takes the one that scores best: the smallest norm of what would be left
(``norm``), or the largest product of what it asks with what is left (``dot``), every dimension
weighted by its capacity.  If none can hold it, a sequence opens.

Packing is done by groups of at most GROUP_PIECES pieces, of which each has the corpus's mix of
lengths, so that a group's last sequences are the only waste.  The sequences that a group leaves less
than FULL full are taken apart and packed again with those of other groups, level by level, until one
group holds them; each level has a small part of the level before.  Pieces of the full length make a
sequence each and don't take part.

Defined results: a null text is empty and is its end id alone; documents of equal id are each packed;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions
from .token_store import Encoder

GROUP_PIECES = 16_384
FULL = 0.985
#: A level leaves at most 0.7 of its pieces, so this many suffice for any table; a sequence id has room for them.
LEVELS = 31


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold; the two last bind only if they are set."""

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], "f8")


def demand(lengths: np.ndarray) -> np.ndarray:
    """What pieces ask of a sequence, a row each."""
    lengths = lengths.astype("f8")
    return np.stack([lengths, np.ones(len(lengths)), lengths**2], 1)


def best_fit(lengths: np.ndarray, capacity: Capacity, score: str = "norm") -> np.ndarray:
    """The bin (0, 1, ...) of each piece.

    Sequences with equal residuals are alike, so they share one entry of the residual table, which
    thus stays small: an entry's sequences are a stack.  Sequences that cannot hold the smallest piece
    leave the table.
    """
    full = capacity.vector()
    asked = demand(lengths) / full
    if (asked > 1).any():
        raise ValueError("a piece is larger than a sequence")
    bins = np.empty(len(lengths), "i8")
    least = asked.min(0) if len(asked) else None
    order = np.lexsort((np.arange(len(lengths)), -asked.max(1)))
    place: dict[bytes, int] = {}
    residual = np.zeros((64, asked.shape[1]))
    stacks: list[list[int]] = []
    unused: list[int] = []
    opened, slack = 0, 1e-12
    exact = np.round(asked * 1e12) / 1e12
    for i in order:
        want = exact[i]
        left = residual[: len(stacks)] - want
        fits = np.flatnonzero((left >= -slack).all(1))
        if len(fits):
            if score == "norm":
                pick = fits[np.argmin((left[fits] ** 2).sum(1))]
            else:
                pick = fits[np.argmax(residual[fits] @ want)]
            b, rest = stacks[pick].pop(), left[pick]
            if not stacks[pick]:
                del place[residual[pick].tobytes()]
                residual[pick] = -1
                unused.append(int(pick))
        else:
            b, rest = opened, 1 - want
            opened += 1
        bins[i] = b
        rest = np.round(np.maximum(rest, 0) * 1e12) / 1e12
        if (rest < least - slack).any():
            continue
        key = rest.tobytes()
        if key in place:
            stacks[place[key]].append(b)
            continue
        if unused:
            at = unused.pop()
            stacks[at] = [b]
        else:
            at = len(stacks)
            stacks.append([b])
            if at == len(residual):
                residual = np.concatenate([residual, np.zeros_like(residual)])
        residual[at] = rest
        place[key] = at
    return bins


def pack(pieces: DataFrame, length_col: str, key: list[str], capacity: Capacity = Capacity(), score: str = "norm") -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces``, whose columns ``key`` tell rows apart.

    Groups are dealt by a number that each row gets, so that repeated rows spread like others; ``pieces``
    should thus be stored.  A group's rows are numbers only: key, length and result.
    """
    pieces = pieces.withColumn("_row", F.monotonically_increasing_id())
    kinds = dict(pieces.dtypes)
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in pieces.columns], "sequence_id long", "offset long", "filled double"])
    spark = pieces.sparkSession
    arrow_length = pieces.columns.index(length_col)
    names = [*pieces.columns, "sequence_id", "offset", "filled"]

    def group(level: int):
        def run(t: pa.Table) -> pa.Table:
            g = t.column("_group")[0].as_py()
            t = t.drop_columns(["_group"]).sort_by([(k, "ascending") for k in [*key, length_col, "_row"]])
            lengths = t.column(arrow_length).to_numpy()
            bins = best_fit(lengths, capacity, score)
            order = np.argsort(bins, kind="stable")
            ends = np.cumsum(lengths[order])
            first = np.flatnonzero(np.r_[True, np.diff(bins[order]) != 0])
            base = np.repeat(ends[first] - lengths[order][first], np.diff(np.r_[first, len(bins)]))
            offset = np.empty(len(bins), "i8")
            offset[order] = ends - lengths[order] - base
            filled = np.bincount(bins, weights=lengths)[bins] / capacity.tokens
            # a level's groups number their sequences apart from all others'
            return pa.table([*t.columns, pa.array((bins << 28 | g) << 5 | level), pa.array(offset), pa.array(filled)], names=names)

        return run

    whole = pieces.where(F.col(length_col) >= capacity.tokens)
    done = whole.select("*", F.shiftleft(F.monotonically_increasing_id(), 5).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(1.0).alias("filled"))
    rest = pieces.where(F.col(length_col) < capacity.tokens)
    n, level = rest.count(), 0
    while n:
        level += 1
        groups = max(1, -(-n // GROUP_PIECES))
        placed = rest.withColumn("_group", F.pmod(F.xxhash64("_row", F.lit(level)), F.lit(groups)))
        placed = cut(placed.groupBy("_group").applyInArrow(group(level), schema))
        if groups == 1:
            done = done.unionByName(placed)
            break
        done = done.unionByName(placed.where(F.col("filled") >= FULL))
        rest = placed.where(F.col("filled") < FULL).select(*pieces.columns)
        before, n = n, rest.count()
        if n > 0.7 * before or level == LEVELS:  # nothing is gained by going on: keep this level's places
            done = done.unionByName(placed.where(F.col("filled") < FULL))
            break
    return done.drop("filled", "_row")


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int, tokens: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes texts and cuts those longer than ``tokens``: ``doc_id, piece, start, length, ids_crc32`` and perhaps ``ids``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = Encoder.of(tokenizer_path, spaced=False)
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                some = b.slice(at, 1000)
                doc, piece, start, length, crc, ids = [], [], [], [], [], []
                for key, raw in zip(some.column(0).to_pylist(), encoder([t or "" for t in some.column(1).to_pylist()])):
                    raw += end
                    for k, lo in enumerate(range(0, len(raw), 4 * tokens)):
                        own = raw[lo : lo + 4 * tokens]
                        doc.append(key)
                        piece.append(k)
                        start.append(lo // 4)
                        length.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        ids.append(own)
                out = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                yield pa.record_batch(out | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def op8_best_fit(spark, sf_dir):
    """Packs all ``documents`` into sequences of at most 2048 tokens."""
    return packed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def packed_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers as P

    pieces = cut(pieces_of(docs, P.path("word_bpe_49k.json"), 0, Capacity().tokens))
    out = pack(pieces, "length", ["doc_id", "piece", "ids_crc32"])
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
