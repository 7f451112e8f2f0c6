"""Fill-in-middle (11), centroid clustering (12) and SentencePiece (13) against brute force, with edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import centroids, fim, pieces

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PATTERNS = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+", "char": r"(?s)."}


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    alphabet = list("aB é\n\t  <>PSM\x00日😀▁  \r?+1") + ["<P>", "the ", "ing", "  ", "\n\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


# --- 11 --------------------------------------------------------------------------------------------


def plainly(key, text, unit, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(PATTERNS[unit], text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (key, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("unit", ["line", "word", "char"])
def test_fill_in_middle_is_the_plain_cut(spark, unit):
    rows = [(k, t) for k, t in enumerate(odd_texts(300))] + [(5, "x\ny"), (5, "x\ny"), (None, "a\nb\nc\n"), (900, None), (901, ""), (902, "\n"), (903, "no end\n"), (904, "x" * 300_000 + "\n" + "y" * 100)]
    docs = spark.createDataFrame([(k, t, "c", 1) for k, t in rows], "doc_id long, text string, output string, n int")
    moved = fim.transform(docs, unit, rate=80, spm=30)
    got = [tuple(r) for r in moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted((plainly(k, t, unit, 80, 30) for k, t in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = moved.select(F.sort_array(F.collect_list(fim.restored("output", "form"))).alias("t")).first()["t"]
    assert back == sorted(t or "" for _, t in rows)


def test_fill_in_middle_of_an_empty_table_and_bad_sentinels(spark):
    assert fim.transform(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    for marks in (("<P>", "<P>", "<M>"), ("<P>", "><", "<M>"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.Sentinels(*marks)
    with pytest.raises(ValueError):
        fim.transform(spark.createDataFrame([], "doc_id long, text string"), unit="page")


def test_fill_in_middle_of_other_sentinels(spark):
    marks = fim.Sentinels("[[p]]", "((s))", "{{m}}")
    texts = ["a\nb [[p] ((s)\n{{m}", "plain as it holds {{m}}\nx", "<P>\nq\n<M>\nz"]
    moved = fim.transform(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), sentinels=marks)
    rows = {r["doc_id"]: r for r in moved.withColumn("t", fim.restored("output", "form", marks)).collect()}
    assert [rows[k]["t"] for k in range(3)] == texts and rows[1]["form"] == "plain" and rows[2]["form"] != "plain" and rows[0]["form"] != "plain"


# --- 12 --------------------------------------------------------------------------------------------


def clustered(rows, k, rounds):
    """Integers of any size, every centroid measured."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v) for i, v in kept if i is not None)[:k]
    c = [v for *_, v in starts]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), o in zip(kept, of) if o == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    return found, c


def test_clusters_are_those_of_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=64) * rng.choice([0.1, 1, 5])).astype("f4").tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (400, [0.0] * 64), (401, [0.0] * 64)]
    rows += [(500, None), (501, []), (502, [1.0] * 63), (503, [1.0] * 63 + [None]), (504, [1.0] * 63 + [float("nan")]), (505, [1.0] * 63 + [float("inf")])]
    df = spark.createDataFrame([(i, v, 1, "x", b"y") for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance string, body binary")
    for k, rounds in ((12, 4), (40, 5)):
        out, centres = centroids.cluster(df.repartition(3), k=k, rounds=rounds)
        found, c = clustered(rows, k, rounds)
        key = lambda r: tuple(str(v) for v in r)
        assert centres.tolist() == c
        assert sorted((tuple(r) for r in out.select("vec_id", "cluster", "distance").collect()), key=key) == sorted(found, key=key)
        facts = centroids.described(out, centres).collect()
        assert len(facts) == len(found) and {r["inertia"] for r in facts} == {sum(f[2] for f in found)}
        for r in facts:
            assert r["cluster_inertia"] == sum(f[2] for f in found if f[1] == r["cluster"])
            assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()


def test_clusters_of_no_and_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    out, centres = centroids.cluster(spark.createDataFrame([], schema))
    assert centroids.described(out, centres).count() == 0
    out, centres = centroids.cluster(spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], schema))
    assert len(centres) == 2 and sorted(r["distance"] for r in out.collect()) == [0, 0]
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], schema))


def test_bounds_never_pass_the_distance_and_spare_some():
    rng = np.random.default_rng(0)
    c = rng.integers(-500, 500, (20, 64)) * rng.integers(1, 40, (20, 8)).repeat(8, axis=1)
    x = c[rng.integers(0, 20, 300)] + rng.integers(-300, 301, (300, 64))  # planted clusters
    norms = lambda v: np.sqrt(np.add.reduceat(v * v, np.arange(0, 64, 8), axis=1).astype("f8"))
    exact = ((x[:, None] - c[None]) ** 2).sum(-1)
    assert (centroids.bounds(norms(x), norms(c)) <= exact).all()
    best, d, measured = centroids.nearest(x, norms(x), c)
    assert (best == exact.argmin(1)).all() and (d == exact.min(1)).all() and measured < exact.size / 2


# --- 13 --------------------------------------------------------------------------------------------


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_the_librarys(spark):
    texts = odd_texts(2000, 3) + ["", None, " ", "   ", "<s></s><unk><0x41>", "a" * 5000, "ab" * 40_000, "the " * 20_000, "▁", "é" * 3000, "\U0001f9ff퟿", "x" + "▁" * 50 + "y"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "none"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(k, t, "c", "d") for k, t in rows], "doc_id long, text string, ids string, decoded string")
    coded = pieces.encode(docs, MODEL)
    sp = library()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in coded.collect()))
    assert got == sorted((k is None, k or 0, sp.encode(t or "")) for k, t in rows)
    back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in pieces.decode(coded, MODEL, ["doc_id"]).collect())
    assert back == sorted((k is None, k or 0, sp.decode(sp.encode(t or ""))) for k, t in rows)
    assert pieces.mismatches(docs, MODEL).count() == 0


def test_decoding_any_ids_is_the_librarys(spark):
    sp, rng = library(), random.Random(2)
    lists = [[rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(259, 275), rng.randrange(32000), 28705]) for _ in range(rng.randrange(9))] for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate([*lists, None])), "k long, ids array<int>")
    got = {r["k"]: r["text"] for r in pieces.decode(df, MODEL, ["k"], "text").collect()}
    assert [got[k] for k in range(len(lists))] == [sp.decode(x) for x in lists] and got[len(lists)] == ""
    with pytest.raises(Exception, match="outside"):
        pieces.decode(spark.createDataFrame([(1, [40_000])], "k long, ids array<int>"), MODEL, ["k"]).collect()


def test_pieces_of_an_empty_table_and_of_another_model(spark, tmp_path):
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string"), MODEL).count() == 0
    raw = open(MODEL, "rb").read()
    with pytest.raises(ValueError):
        pieces.Vocabulary.of(raw.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"))


def test_agenda_takes_unused_pieces_apart_and_keeps_user_symbols():
    names = ["<unk>", "a", "b", "c", "ab", "abc", "▁", "xy", "x", "y"]
    kinds = [2, 1, 1, 1, 5, 1, 1, 4, 1, 1]
    v = pieces.Vocabulary(names, [0.0, -9, -9, -9, -1, -2, -9, 0, -9, -9], kinds, True, False, " ⁇ ")
    word = lambda p: [names[i] for i in v.merge(p)]
    assert word("abc") == ["abc"] and word("abb") == ["a", "b", "b"] and word("▁axyb") == ["▁", "a", "xy", "b"] and word("q") == ["<unk>"]


def test_queries_give_the_contracts_rows(spark):
    from lodestone.llm import registry

    sf = "/root/testdata/sf0.001"
    sp = library()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in registry.QUERIES["op13_sentencepiece"](spark, sf).collect()}
    for r in docs:
        ids = sp.encode(r["text"] or "")
        assert tuple(got[r["doc_id"]]) == (r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    got = {r["doc_id"]: r for r in registry.QUERIES["op11_fill_in_middle"](spark, sf).collect()}
    for r in docs:
        k, n, form, p, m, output = plainly(r["doc_id"], r["text"], "line")
        assert tuple(got[k]) == (k, n, form, p, m, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, _ = clustered(vectors, 40, 5)
    rows = registry.QUERIES["op12_centroids"](spark, sf).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in rows) == sorted(found)


# --- articles of ordinary layouts (10) --------------------------------------------------------------


def test_short_articles_in_ordinary_layouts_are_kept():
    from lodestone.llm import html_extract

    trees = html_extract.train()
    p = "This is a plain sentence of about eighty characters that says something, really."
    cookie = '<div class="cookie">We use cookies. <a href=x>OK</a></div>'
    menu = "<nav><a href=a>Home</a><a href=b>News</a></nav>"
    cases = {
        f'<div id="content"><p>{p}</p></div>': p,
        f'{cookie}<div class="content"><p>{p}</p><p>{p}</p></div>': f"{p}\n{p}",
        f'{cookie}<div id="content">{f"<p>{p} {p}</p>" * 8}</div>': "\n".join([f"{p} {p}"] * 8),
        f'{menu}<main><div class="post"><p>{p} <span>{p}</span></p></div></main>': f"{p} {p}",
        f'<article><div class="post"><h1>T</h1><p>{p}</p></div></article>': f"T\n{p}",
        f'{cookie}<div id="content"><h1>Title</h1><p>{p}</p><p>{p}</p></div>': f"Title\n{p}\n{p}",
        f"<html><head><title>x</title></head><body>{menu}<div id=content><p>{p}</p></div><footer>c 2020</footer></body></html>": p,
        f"<article><p>{p} {p}</p><footer>Share this</footer></article>": f"{p} {p}",
        menu: "",
        "<script>var a = 1;</script>": "",
    }
    assert {k: html_extract.main_text(k, trees) for k in cases} == cases


# --- quality on small samples (5) -------------------------------------------------------------------


def test_low_quality_is_found_with_few_labels_and_scores_are_the_plain_sum(spark):
    """Held-out documents at sf0.01 (329 labels), and every score against all pairs of slots one by one."""
    from lodestone.llm import quality_fm

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    out = quality_fm.op5_quality(spark, sf).join(labels.where("quality is not null"), "doc_id").where("held_out").toPandas()
    bad, good = out[out.quality == 0], out[out.quality == 1]
    assert (bad.predicted == 0).mean() > 0.9 and (good.predicted == 1).mean() > 0.9
    m = quality_fm.train(docs, labels)
    for r in docs.limit(5).collect():
        at, x = quality_fm.features(r["text"][:300], {})
        pairs = sum(float(m.factors[a] @ m.factors[b]) * float(x[i]) * float(x[j]) for i, a in enumerate(at) for j, b in enumerate(at) if i < j)
        plain = 1 / (1 + np.exp(-(m.bias + sum(float(m.linear[a]) * float(v) for a, v in zip(at, x)) + pairs)))
        assert abs(m.scores([(at, x)])[0] - plain) < 1e-4


# --- the pipeline's stages --------------------------------------------------------------------------


def test_stages_keep_rows_whole_with_nulls_repeats_and_nothing(spark, tmp_path):
    """Every stage on its own: kept rows are rows of its input, filters decide row by row, near copies leave one; an empty table stays empty."""
    import corpus_pipeline as C

    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    clean = [" ".join(word() for _ in range(60)) for _ in range(120)]
    foul = [" ".join(rng.choice(["idiot", "moron", "hate", word()]) for _ in range(60)) for _ in range(40)]
    junk = ["$$$ !!! " * 40 for _ in range(20)]
    texts = clean + foul + junk
    near = clean[0].rsplit(" ", 1)[0] + " zzzzz"
    rows = [(k, t, "en", "web", len(t)) for k, t in enumerate(texts)] + [(500, near, "en", "web", 9), (501, clean[1], None, None, None), (502, None, "en", "web", 0), (503, "", "en", "web", 0), (7, clean[7], "en", "web", 1), (None, clean[9], "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = [(k, 0 if t in junk else 1, 1 if t in foul else 0) for k, t in enumerate(texts)] + [(3, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given = {tuple(r) for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        got = [tuple(r) for r in kept.collect()]
        assert set(got) <= given and stage(spark, docs.where("false"), str(tmp_path)).isEmpty()
        ids = {r[0] for r in got}
        if name == "toxicity":
            assert not ids & set(range(120, 160)) and ids >= set(range(120)) | {500, 501, 502, 503}
        elif name == "quality":
            assert not ids & set(range(160, 180)) and ids >= set(range(120))
        else:
            assert {0, 1, 7, 160, 502, 503} <= ids and not ids & {500, 501, *range(161, 180)} and [r[0] for r in got].count(7) == 1
    packed = C.packing_stage(spark, docs, str(tmp_path))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
    assert packed.count() == len(rows) and C.packing_stage(spark, docs.where("false"), str(tmp_path)).isEmpty()
    more = docs.withColumn("score", F.lit("x")).withColumn("toxic", F.lit("y"))
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, more, str(tmp_path)).columns == more.columns
