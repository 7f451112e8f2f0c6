"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata (operator 5).

A document's features are its distinct words (``\\w+`` lower-cased and hashed to WORD_SLOTS slots,
weighted so that their squares sum to 1), statistics of its structure, and its length as the only
metadata: language, source and id are no inputs.  The score is a sigmoid of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so pairwise interactions cost time linear in the features.  The machine is fitted by Adam on the
driver, on at most ``sample`` labelled documents (a documented bound; a uniform choice by hash), of
which only numbers reach the driver.  Scoring is one pass over whole texts without a shuffle; the
model is of fixed size.

Defined results: null and empty texts are scored like any other, by their statistics; labels that are
null, or that contradict each other for one document, are left out of fitting; without any usable
label, or with labels of one kind only, every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_SLOTS = 1 << 14
SAMPLE = 6000
STEPS = 600
FACTORS = 6
THRESHOLD = 0.3
_WORD = re.compile(r"\w+")
STATISTICS = ("log_chars", "log_words", "log_lines", "letters", "digits", "space", "symbols", "pipes", "upper", "mean_word", "long_words", "distinct_words", "top_word", "distinct_lines", "mean_line", "odd_ends", "sentence_ends", "repeats", "bigrams", "one_letter")


def statistics(text: str, words: list[str]) -> np.ndarray:
    """Shares and log counts that describe a whole text's structure."""
    n = max(len(text), 1)
    tokens = text.split()
    k = max(len(tokens), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words)) if words else 0
    digits = len(re.findall(r"\d", text))
    space = text.count(" ") + text.count("\n") + text.count("\t")
    counts: dict[str, int] = {}
    for t in tokens:
        counts[t] = counts.get(t, 0) + 1
    repeats = sum(a == b for a, b in zip(tokens, tokens[1:]))
    odd = sum(not (t[-1].isalnum() or t[-1] in ".,;:!?)'\"") for t in tokens)
    return np.array([
        np.log1p(len(text)) / 8, np.log1p(len(tokens)) / 6, np.log1p(len(lines)) / 4, letters / n, digits / n, space / n, max(0, n - letters - space) / n, text.count("|") / k, sum(map(str.isupper, text)) / n,
        letters / max(len(words), 1) / 8, sum(len(t) > 15 for t in tokens) / k, len(counts) / k, max(counts.values(), default=0) / k, len(set(lines)) / max(len(lines), 1), np.log1p(k / max(len(lines), 1)) / 4,
        odd / k, sum(t[-1] in ".!?" for t in tokens) / k, repeats / k, len(set(zip(tokens, tokens[1:]))) / k, sum(len(t) == 1 for t in tokens) / k,
    ], "f4")


def features(text: str | None, slots: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of a document's features; ``slots`` remembers words' hashes."""
    text = text or ""
    words = _WORD.findall(text.lower())
    if len(slots) > 500_000:
        slots.clear()
    seen = set()
    for w in set(words):
        s = slots.get(w)
        if s is None:
            s = slots[w] = zlib.crc32(w.encode()) % WORD_SLOTS
        seen.add(s)
    at = np.fromiter(sorted(seen), "i4", len(seen))
    stats = statistics(text, words)
    values = np.concatenate([np.full(len(at), 1 / np.sqrt(max(len(at), 1)), "f4"), stats])
    return np.concatenate([at, WORD_SLOTS + np.arange(len(stats), dtype="i4")]), values


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        ends = np.cumsum([len(a) for a, _ in docs])
        at, x = np.concatenate([a for a, _ in docs]), np.concatenate([v for _, v in docs])
        starts = np.r_[0, ends[:-1]]
        total = lambda v: np.add.reduceat(v, starts, axis=0)  # noqa: E731  every document has its statistics
        vx = self.factors[at] * x[:, None]
        return self.bias + total(self.linear[at] * x) + 0.5 * (total(vx) ** 2 - total(vx**2)).sum(1)

    def scores(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(docs), -30, 30)))


def fit(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.02, decay: float = 1e-4, seed: int = 5) -> Machine:
    """Logistic loss by Adam; weight decay on the words' weights and all factors.

    Small samples get smaller batches and more epochs, STEPS steps at least: fewer leave the scores at the
    share of good documents, above any threshold.
    """
    batch = min(batch, max(16, len(y) // 20))
    epochs = max(epochs, -(-STEPS * batch // max(1, len(y))))
    rng = np.random.default_rng(seed)
    size = WORD_SLOTS + len(STATISTICS)
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, "f4"), rng.normal(0, 0.02, (size, FACTORS)).astype("f4"))
    if not len(y) or y.min() == y.max():
        m.factors[:] = 0
        return m
    params = [np.array([m.bias]), m.linear, m.factors]
    moments = [(np.zeros_like(p, "f4"), np.zeros_like(p, "f4")) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            some = [docs[i] for i in order[lo : lo + batch]]
            at, x = np.concatenate([a for a, _ in some]), np.concatenate([v for _, v in some])
            row = np.repeat(np.arange(len(some)), [len(a) for a, _ in some])
            m.bias = float(params[0][0])
            vx = m.factors[at] * x[:, None]
            starts = np.searchsorted(row, np.arange(len(some)))
            sums = np.add.reduceat(vx, starts, axis=0)
            margin = m.bias + np.add.reduceat(m.linear[at] * x, starts) + 0.5 * (sums**2 - np.add.reduceat(vx**2, starts, axis=0)).sum(1)
            g = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[order[lo : lo + batch]]) / len(some)
            gx = (g[row] * x).astype("f4")
            grads = [np.array([g.sum()]), decay * m.linear, decay * m.factors]
            np.add.at(grads[1], at, gx)
            np.add.at(grads[2], at, gx[:, None] * (sums[row] - vx))
            step += 1
            for p, d, (a, b) in zip(params, grads, moments):
                a *= 0.9
                a += 0.1 * d
                b *= 0.99
                b += 0.01 * d * d
                p -= rate * (1 - epoch / epochs) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    m.bias = float(params[0][0])
    return m


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """``text, y`` of at most ``sample`` labelled documents outside the held-out fifth, chosen by hash."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    one = usable.groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_most")).where("y = _most").select("doc_id", "y")
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # the chosen ids are bounded by the sample, so they are broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Machine:
    """Fits the machine; executors turn the sample's texts to features, the driver gets those numbers."""

    def run(batches):
        slots: dict[str, int] = {}
        for b in batches:
            made = [features(t, slots) for t in b.column(0).to_pylist()]
            yield pa.record_batch({"at": pa.array([a.tobytes() for a, _ in made], pa.binary()), "x": pa.array([x.tobytes() for _, x in made], pa.binary()), "y": b.column(1).cast(pa.int32())})

    rows = training_rows(docs, labels, label, sample).mapInArrow(run, "at binary, x binary, y int").collect()
    rows.sort(key=lambda r: (zlib.crc32(bytes(r["at"])), bytes(r["x"]), r["y"]))  # the same model whatever the tasks' order
    return fit([(np.frombuffer(r["at"], "i4"), np.frombuffer(r["x"], "f4")) for r in rows], np.array([r["y"] for r in rows], "f4"))


def score(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """Adds ``score`` to ``docs`` (in place of a column of that name)."""
    kept = [c for c in docs.columns if c != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = kept.index(text_col)

    def run(batches):
        slots: dict[str, int] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                some = b.slice(lo, 200)
                values = shared.value.scores([features(t, slots) for t in some.column(at).to_pylist()])
                yield pa.record_batch([*some.columns, pa.array(values.astype("f8"))], names=[*kept, "score"])

    kinds = dict(docs.dtypes)
    return docs.select(*kept).mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "score double"]))


def op5_quality(spark, sf_dir):
    """Scores every text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    machine = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs.select("doc_id", "text"), machine)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
