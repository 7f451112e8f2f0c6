r"""Toxicity severity by cumulative-link ordinal regression on sparse text features (operator 9).

Grades run from 0 (clean) to 3.  Labels tell toxic from clean; a toxic labelled document's grade comes
from how much of it is abusive: the number of its words that mark toxic documents, in all and against
its length.  The model has one weight vector and ordered thresholds,

    P(grade > k | x) = sigmoid(w.x - theta_k),   theta_0 <= theta_1 <= theta_2,

and a document's severity is the expected grade, the sum of those probabilities.  It is rejected if
grade 1 or more is likelier than not.

Features are word beginnings (STEM letters of a lower-cased ``\w+``) that the labelled sample ties to
toxicity, each by presence and by number; stems rather than words, as languages inflect them.  They
are chosen by how much commoner they are in toxic documents than in clean ones; of stems that begin
alike one stays.  Stems are kept as such, so no other word shares a weight, and long clean texts gain
nothing by being long.  Near copies, told by two least hashes of their long words, count once in that
choice, so that no copied text makes its own words suspect.

Fitting takes at most ``sample`` labelled documents (a documented bound), toxic ones first up to three
eighths.  Counting and grading run on executors; the driver gets counts of candidate stems and the
chosen stems' counts of each document.  Scoring is one pass over whole texts without a shuffle.

Defined results: null and empty texts have no features and get the base severity; null labels, and
labels that contradict each other for one document, are left out; without toxic or clean labels
nothing is rejected and severity is 0.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SAMPLE = 8_000
#: Lengths of word beginnings that may become features.
STEM = range(3, 9)
GRADES = 4
_WORD = re.compile(r"\w+")


@dataclass
class Ordinal:
    words: tuple[str, ...]
    weights: np.ndarray  # of each stem's presence, of its log number, then of the log number of all hits and their share
    thresholds: np.ndarray

    def severity(self, x: np.ndarray) -> np.ndarray:
        return self.exceed(x).sum(1)

    def exceed(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return 1 / (1 + np.exp(-np.clip((x @ self.weights)[:, None] - self.thresholds[None], -30, 30)))


def counts_of(text: str | None, index: dict[str, int], pattern: re.Pattern | None) -> tuple[np.ndarray, int]:
    """Number of each known word in the whole text, and the number of its words."""
    counts = np.zeros(len(index), "i4")
    text = (text or "").lower()
    if pattern is not None:
        for w in pattern.findall(text):
            counts[index[w]] += 1  # of stems that begin alike only one is known
    return counts, text.count(" ") + text.count("\n") + 1


def matrix(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    hits = counts.sum(1)
    return np.concatenate([(counts > 0).astype("f8"), np.log1p(counts), np.log1p(hits)[:, None], np.sqrt(np.minimum(1, 20 * hits / np.maximum(sizes, 1)))[:, None]], 1)


def grades(counts: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for any toxic document, one more from three abusive words, one more where they are a fiftieth of all words."""
    hits = counts.sum(1)
    return np.where(toxic > 0, 1 + (hits >= 3) + (hits * 50 >= sizes), 0)


def fit(words: tuple[str, ...], x: np.ndarray, grade: np.ndarray, rounds: int = 400, rate: float = 0.1, decay: float = 1e-3) -> Ordinal:
    """Maximum likelihood by Adam; thresholds are a first one and positive steps, so they stay in order.

    The loss is that of the cumulative probabilities: a logistic loss for each threshold, all sharing w.
    """
    k = GRADES - 1
    w, base, steps = np.zeros(x.shape[1]), np.array([0.0]), np.zeros(k - 1)
    above = (grade[:, None] > np.arange(k)[None]).astype("f8")
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, base, steps)]
    for t in range(1, rounds + 1):
        theta = np.concatenate([base, base + np.cumsum(np.log1p(np.exp(steps)))])
        p = 1 / (1 + np.exp(-np.clip((x @ w)[:, None] - theta[None], -30, 30)))
        d = (p - above) / len(x)
        by_theta = -d.sum(0)
        rest = np.cumsum(by_theta[::-1])[::-1][1:]
        grads = [x.T @ d.sum(1) + decay * w / len(w), np.array([by_theta.sum()]), rest / (1 + np.exp(-steps))]
        for q, g, m in zip((w, base, steps), grads, moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.99 * m[1] + 0.01 * g * g
            q -= rate * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-9)
    return Ordinal(words, w, np.concatenate([base, base + np.cumsum(np.log1p(np.exp(steps)))]))


def compiled(words: tuple[str, ...]) -> re.Pattern | None:
    """Finds the stems where a word begins."""
    return re.compile(r"\b(?:" + "|".join(sorted(map(re.escape, words), key=lambda w: (-len(w), w))) + r")") if words else None


def likeness(text: str) -> str:
    """Equal for near copies, mostly: two least hashes of the text's long words."""
    long = {w for w in _WORD.findall(text.lower()) if len(w) > 7}
    if len(long) < 5:
        return f"t{zlib.crc32(text.encode())}"
    return f"{min(zlib.crc32(w.encode()) for w in long)} {min(zlib.crc32(w.encode(), 77) for w in long)}"


def choose(candidates: list[tuple[str, int, int]], n1: int, n0: int, most: int) -> tuple[str, ...]:
    """Stems by the share of toxic documents that have them less 20 times that of clean ones; longer ones first among equals."""
    worth = sorted(((a / n1 - 20 * b / n0, len(s), s) for s, a, b in candidates), key=lambda x: (-x[0], -x[1], x[2]))
    chosen: dict[str, None] = {}
    begun: set[str] = set()
    for w, _, s in worth:
        if w <= 0 or len(chosen) == most:
            break
        if s in begun or any(s[:k] in chosen for k in range(1, len(s))):
            continue
        chosen[s] = None
        begun.update(s[:k] for k in range(1, len(s) + 1))
    return tuple(sorted(chosen))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, most_words: int = 200) -> Ordinal:
    """Fits the model on labelled documents: all usable ones, or ``sample`` of them chosen by hash.

    The features are at most ``most_words`` stems, those that tell most of toxic documents; documents are rated
    whole whatever the bound.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("_most")).where("y = _most").select("doc_id", "y")
    by_hash = lambda y, n: one.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = by_hash(1, sample * 3 // 8).union(by_hash(0, sample - sample * 3 // 8))
    sampled = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "y"))

    def keyed(batches):
        for b in batches:
            yield pa.record_batch({"key": pa.array([likeness(t) for t in b.column(0).to_pylist()]), "text": b.column(0), "y": b.column(1).cast(pa.int32())})

    def stems(batches):
        for b in batches:
            counts: dict[str, list[int]] = {}
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for s in {w[:k] for w in set(_WORD.findall(t.lower())) for k in STEM if len(w) >= k}:
                    counts.setdefault(s, [0, 0])[y] += 1
            yield pa.record_batch({"stem": pa.array(counts, pa.string()), "a": pa.array([c[1] for c in counts.values()], pa.int64()), "b": pa.array([c[0] for c in counts.values()], pa.int64())})

    apart = sampled.mapInArrow(keyed, "key string, text string, y int").groupBy("key", "y").agg(F.min("text").alias("text")).select("text", "y")
    totals = {r["y"]: r["n"] for r in apart.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return Ordinal((), np.zeros(2), np.full(GRADES - 1, 30.0))
    per = apart.mapInArrow(stems, "stem string, a long, b long").groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    picked = per.where((F.col("a") >= max(3, n1 / 100)) & (F.col("b") / n0 * 20 < F.col("a") / n1)).collect()
    words = choose([tuple(r) for r in picked], n1, n0, most_words)
    index = {w: i for i, w in enumerate(words)}

    def run(batches):
        pattern = compiled(words)
        for b in batches:
            made = [counts_of(t, index, pattern) for t in b.column(0).to_pylist()]
            yield pa.record_batch({"c": pa.array([c.tobytes() for c, _ in made], pa.binary()), "n": pa.array([n for _, n in made], pa.int32()), "y": b.column(1).cast(pa.int32())})

    rows = sampled.mapInArrow(run, "c binary, n int, y int").groupBy("c", "n", "y").agg(F.count("*").alias("times")).orderBy("c", "n", "y").collect()
    counts = np.stack([np.frombuffer(r["c"], "i4") for r in rows]).repeat([r["times"] for r in rows], 0)
    sizes, y = (np.repeat([r[k] for r in rows], [r["times"] for r in rows]) for k in ("n", "y"))
    # a toxic label without any abusive word says nothing of words: it stays, as noise of grade 1
    return fit(words, matrix(counts, sizes), grades(counts, sizes, y))


def rate(docs: DataFrame, model: Ordinal, text_col: str = "text") -> DataFrame:
    """Adds ``severity``, ``grade`` (the likeliest) and ``toxic`` to ``docs``, in place of columns so named."""
    kept = [c for c in docs.columns if c not in ("severity", "grade", "toxic")]
    at = kept.index(text_col)
    index = {w: i for i, w in enumerate(model.words)}

    def run(batches):
        pattern = compiled(model.words)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                some = b.slice(lo, 1000)
                made = [counts_of(t, index, pattern) for t in some.column(at).to_pylist()]
                p = model.exceed(matrix(np.stack([c for c, _ in made]), np.array([n for _, n in made])))
                each = np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], 1), axis=1) * -1
                yield pa.record_batch([*some.columns, pa.array(p.sum(1)), pa.array(each.argmax(1).astype("i4")), pa.array(p[:, 0] > 0.5)], names=[*kept, "severity", "grade", "toxic"])

    kinds = dict(docs.dtypes)
    return docs.select(*kept).mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "severity double, grade int, toxic boolean"]))


def op9_toxicity(spark, sf_dir):
    """Rates every text of ``documents``: doc_id, severity (0 to 3), grade, toxic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rate(docs.select("doc_id", "text"), model).drop("text")
