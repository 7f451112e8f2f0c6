"""Packing against whole-text encoding; empty tables, repeats and clashing columns of the scoring operators."""

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from lodestone.llm import html_extract, packing, quality_fm, token_store, toxicity  # noqa: E402


def test_pieces_are_cuts_of_whole_texts(spark):
    """Ids, cuts at 2048, starts and checksums against the library on whole texts; long, empty, null, repeated and nameless rows."""
    from tokenizers import Tokenizer

    k, rng = Tokenizer.from_file(P.path("word_bpe_49k.json")), random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(1, 8)))
    texts = [None, "", " ", *(" ".join(word() for _ in range(rng.choice([1, 20, 600, 3000]))) for _ in range(30))]
    rows = [*enumerate(texts), (5, texts[5]), (5, texts[6]), (None, texts[7]), (None, texts[7])]
    want = []
    for i, t in rows:
        ids = [*k.encode(t or "", add_special_tokens=False).ids, 0]
        for n, lo in enumerate(range(0, len(ids), 2048)):
            own = ids[lo : lo + 2048]
            want.append((-1 if i is None else i, n, lo, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, length int, sequence_id string")
    out = packing.packed_documents(df).toPandas()
    got = out.assign(doc_id=out.doc_id.fillna(-1).astype("int64"))[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all() and out.groupby("sequence_id").length.sum().max() <= 2048


def test_store_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    token_store.write(none, str(tmp_path / "s"), P.path("byte_bpe_50k.json"), 2)
    assert token_store.scan(spark.read.parquet(str(tmp_path / "s"))).count() == 0


def test_scores_with_clashing_columns_and_of_nothing(spark):
    """Rows keep their number; columns named as results, repeated rows and null ids don't disturb; contradictory labels are all learned."""
    rng = random.Random(7)
    texts = [" ".join(rng.choice(("plain good words" if k % 2 else "buy cheap now").split()) for _ in range(40)) for k in range(200)]
    rows = [(k, t, 9.0, "x", 3) for k, t in enumerate(texts)] + [(None, texts[1], 9.0, "x", 3), (1, texts[1], 9.0, "x", 3), (1, None, 9.0, "x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double, toxic string, severity int")
    labels = spark.createDataFrame([(k, k % 2, 1 - k % 2) for k in range(200)] + [(1, 0, 1), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    clean = df.select("doc_id", "text")
    scored = quality_fm.score(clean, quality_fm.train(clean, labels))
    assert scored.count() == len(rows) and scored.where("score is null or score < 0 or score > 1").isEmpty()
    machine, model = quality_fm.train(df, labels), toxicity.train(df, labels)
    assert quality_fm.score(df, machine).count() == toxicity.rate(df, model).count() == len(rows)
    assert quality_fm.score(df.where("false"), machine).count() == toxicity.rate(df.where("false"), model).count() == 0


def test_pages_of_nothing(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string"), html_extract.train()).count() == 0
