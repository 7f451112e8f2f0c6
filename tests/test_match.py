"""Vocabulary hits by the join against a plain scan of every text for every surface."""

import random
import re

import numpy as np
import pyarrow as pa

from lodestone.operators import match


def plainly(text, vocab):
    """Longest surface first at every place of the text; capitals keep their case."""
    text, found = text or "", []
    for surface, target in sorted(vocab, key=lambda v: (-len(v[0]), v[0], v[1])):
        upper = surface == surface.upper() and surface != surface.lower()
        if len(surface) < 3 and not (len(surface) == 2 and upper and surface.isalpha()):
            continue
        for m in re.finditer(f"(?=({re.escape(surface)}))", text, 0 if upper else re.I):
            a, b = m.start(), m.start() + len(surface)
            if (a and re.match(r"\w", text[a - 1])) or re.match(r"\w", text[b : b + 1]) or any(a < y and x < b for x, y, *_ in found):
                continue
            found.append((a, b, surface, target))
    return sorted(found)


def test_hits_are_those_of_a_plain_scan(spark):
    rng = random.Random(8)
    word = lambda: rng.choice(["a", "the", "and", "EP", "Ep", "x1", "über", "don't", "+++", "...", "-", "no_one", "日本", "THE", "%%%!"])
    phrase = lambda n: "".join(word() + rng.choice([" ", " ", "-", "", ", "]) for _ in range(rng.randint(1, n))).strip()
    vocab = [(phrase(3), k % 17) for k in range(400)] + [("+++", 3), ("+++", 1), ("THE", 5), ("-+-", 6), ("   ", 7), ("ab", 8), ("AB", 9)]
    texts = [phrase(40) for _ in range(300)] + [None, "", "+++", "++++", "AB ab Ab", "the " * 3000]
    rows = [(k, t, "c") for k, t in enumerate(texts)] + [(5, texts[5], "c"), (None, texts[6], "c")]
    df = spark.createDataFrame(rows, "id long, text string, surface string")
    words = spark.createDataFrame(vocab, "surface string, target int")
    got = {r["id"]: [tuple(x) for x in r["hits"]] for r in match.hits(df, words, "text").where("id is not null").collect()}
    kept = [(" ".join(s.split()), t) for s, t in vocab]
    for k, t in enumerate(texts):
        assert got[k] == plainly(t, kept), t
    assert match.match(df, words, "id", "text").where("id is null").count() == len(got[6])
    claimed = match.hits(df.where("id = 305"), words, "text", claimed=lambda t: [(0, 20)]).first()["hits"]
    assert claimed and claimed[0]["start"] >= 20
    assert match.hits(df, words.where("false"), "text").where("size(hits) > 0").isEmpty() and match.hits(df.where("false"), words, "text").isEmpty()


def test_candidates_stand_as_objects_only_some_at_a_time():
    """A batch of 10,000 texts, whatever they met, used to be turned into objects at once."""
    met = pa.array([[{"surface": "a b"}] * n for n in (0, 3, match.AT_ONCE + 1, 0, match.AT_ONCE - 5, 5, 1)])
    parts = list(match.by_size(pa.record_batch({"k": np.arange(7), "met": met}), "met", match.AT_ONCE))
    assert [p.column("k").to_pylist() for p in parts] == [[0, 1], [2], [3, 4, 5], [6]]
    assert pa.concat_arrays([p.column("met") for p in parts]).equals(met)


def test_more_candidates_than_stand_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(match, "AT_ONCE", 3)
    rows = [(k, "one two, two three; one two " * (k % 5) if k else None) for k in range(40)]
    words = spark.createDataFrame([("one two", 1), ("two three", 2), ("three", 3)], "surface string, target int")
    for r in match.hits(spark.createDataFrame(rows, "id long, text string").coalesce(1), words, "text").collect():
        assert [tuple(x) for x in r["hits"]] == plainly(rows[r["id"]][1], [("one two", 1), ("two three", 2), ("three", 3)])


def test_a_vocabulary_of_any_size(spark):
    """More surfaces than any task could be given as a list; each text finds its own."""
    words = spark.range(0, 300_000).selectExpr("concat('name ', id, ' of item') surface", "id target")
    df = spark.range(0, 200).selectExpr("id", "concat('see Name ', id * 1499, ' OF item, not name ', id, 'x of item') text")
    got = match.match(df, words, "id", "text").collect()
    assert sorted((r["id"], r["target"], r["start"]) for r in got) == [(k, k * 1499, 4) for k in range(200)]


def test_spans_in_expressions_are_those_of_the_plain_functions(spark):
    from lodestone.operators import references

    rng = random.Random(4)
    bits = ["Relics 1, 2 and 003", "relic 7", "RELICS 5&6", "refine tree node 12", "Refine node 4", "fire node 3", "Earth  Node 10", "King of Cups", "ace of  SWORDS", "xrelic 1", "based on", "by amount of", "Based On", "(", ")", "((", "and", "é", "😀 ", "nodes", "wind node", "of cups"]
    texts = ["".join(rng.choice(bits) + rng.choice([" ", " ", ", ", ""]) for _ in range(rng.randrange(14))) for _ in range(600)] + [None, "", "based on", "(based on)"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for r in df.select("id", references.entity_spans("text").alias("e"), references.governed_spans("text").alias("g")).collect():
        t = texts[r["id"]] or ""
        assert [tuple(x) for x in r["e"]] == references.entities(t), t
        assert [tuple(x) for x in r["g"]] == references.input_spans(t), t
