"""The data preparation operators against brute force, and their edge cases."""


import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

from lodestone.llm import ann, bpe, html_extract, jaccard, near_dedup, packing, quality_fm, token_store, toxicity, url_filter  # noqa: E402

TEXTS = [None, "", " ", "a", "a a", "The  quick\n\nbrown fox's 12 jumps \n ok ", "x" * 5000, "日本 é İ. <|endoftext|>\t", "same words here again " * 400, "the and of " * 3, "the and of " * 3]


def docs(spark, texts=TEXTS):
    rows = [(k, t, "clash") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def stored(df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    return df.sparkSession.read.parquet(str(tmp_path / "t"))


def test_bpe_round_trip(spark, tmp_path):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    d = stored(docs(spark), tmp_path)
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(d, path, P.PATTERN), path, ["doc_id", "ids"]).collect()}
    for k, t in enumerate(TEXTS):
        assert np.frombuffer(bytes(got[k]["ids"]), "<u4").tolist() == enc.encode_ordinary(t or "")
        assert bytes(got[k]["decoded"]).decode() == (t or "")
    assert bpe.encode(stored(docs(spark, []), tmp_path / "e"), path, P.PATTERN).count() == 0


def test_a_block_is_cut_into_chunks_in_little_memory():
    """Masks of a whole block's bytes took several times its size in every worker."""
    import tracemalloc

    texts = [b"some words\nand more " * 500 for _ in range(1000)] + [b"", "\u00a0two  gaps\u2003\n".encode(), b""]
    tracemalloc.start()
    chunks, codes, ends = bpe.chunk_codes(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 5 * sum(map(len, texts))
    found, lo = chunks.to_pylist(), 0
    for t, hi in zip(texts, ends.tolist()):
        assert b"".join(found[c] for c in codes[lo:hi]) == t
        lo = hi


def test_token_store(spark, tmp_path):
    from tokenizers import Tokenizer

    k = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    d = docs(spark).union(docs(spark, TEXTS[5:6]))  # id 0 twice
    path = str(tmp_path / "s")
    token_store.write(d, path, P.path("byte_bpe_50k.json"), 2)
    store = spark.read.parquet(path)
    got = sorted(token_store.scan(store).collect(), key=lambda r: (r["doc_id"], r["occurrence"]))
    want = sorted(((i, t) for i, t in [*enumerate(TEXTS), (0, TEXTS[5])]), key=lambda x: (x[0], x[1] or ""))
    start = 0
    for r, (i, t) in zip(got, want, strict=True):
        ids = [*k.encode(t or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    found = {r["doc_id"]: bytes(r["ids"]) for r in token_store.lookup(store, spark.createDataFrame([(6,), (99,), (None,)], "doc_id long")).collect()}
    assert list(found) == [6] and np.frombuffer(found[6], "<u4").tolist() == [*k.encode(TEXTS[6], add_special_tokens=False).ids, 2]


def test_pieces_give_the_ids_of_whole_texts():
    from tokenizers import Tokenizer

    rng = random.Random(3)
    parts = [" ", "  ", "\n", " \n", "\t", "\r\n", "a", "Bc", "é", "\x01", "\x1c", "\xa0", "1", "'s", ".", "...", "İ", "Σ", "́", "日", "🙂", "\x85", ",", "&&&", "!?", "ß", "Éa", "ª", "²", "µ", "$."]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        e = token_store.Encoder(P.path(name), spaced)
        k = Tokenizer.from_file(P.path(name))
        for t, raw in zip(texts, e(texts)):
            assert np.frombuffer(raw, "<u4").tolist() == k.encode(t, add_special_tokens=False).ids, ascii(t)


@pytest.mark.parametrize("capacity", [packing.Capacity(), packing.Capacity(100, 4), packing.Capacity(100, None, 5000)])
@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_respects_every_capacity(capacity, score):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, min(capacity.tokens, 70) + 1, 3000)
    bins = packing.best_fit(lengths, capacity, score)
    full = capacity.vector()
    for col, most in zip(packing.demand(lengths).T, full):
        assert np.bincount(bins, weights=col).max() <= most
    least = max(np.ceil(col.sum() / most) for col, most in zip(packing.demand(lengths).T, full))
    assert bins.max() + 1 <= 1.25 * least


def test_packing_is_gapless(spark):
    out = packing.packed_documents(docs(spark)).toPandas().sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert set(out.doc_id) == set(range(len(TEXTS)))


def brute_sets(texts, words):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    return sets


@pytest.mark.parametrize(("percent", "words"), [(90, 3), (80, 5)])
def test_jaccard_against_brute_force(spark, percent, words):
    rng = random.Random(words)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 150))] for _ in range(25)]
    texts = list(TEXTS)
    for b in base:
        for _ in range(rng.randint(1, 8)):
            w = list(b)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = "new" + str(rng.randint(0, 999))
            texts.append(" ".join(w))
    sets = brute_sets(texts, words)
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs(spark, texts), percent, words).collect()}
    assert got == {k: (len(sets[k]), label[k]) for k in range(len(texts))}


def vectors(spark, n=300, d=16):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(n, d))
    for i in range(0, n, 3):
        v[i + 1] = v[i] + rng.normal(size=d) * rng.choice([0.05, 0.2, 0.4])
    v[7], v[8] = v[6], v[6]
    rows = [(k, [float(x) for x in r], k % 2 if k not in (6, 7, 8) else 0) for k, r in enumerate(v)]
    rows += [(n, None, 1), (n + 1, [0.0] * d, 1), (n + 2, [float("nan")] * d, 1), (n + 3, [None] * d, 1), (n + 4, rows[0][1], None), (n + 5, [], 0), (n + 6, [float("inf")] * d, 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows[:n]


def test_near_duplicates_against_brute_force(spark):
    df, rows = vectors(spark)
    v = np.array([r[1] for r in rows])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    lab = np.array([r[2] for r in rows])
    links = (u @ u.T >= 0.93) & (lab[:, None] == lab[None])
    np.fill_diagonal(links, False)
    got = {r["vec_id"]: r for r in near_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows) + 7
    assert [got[k]["n_links"] for k in range(len(rows))] == links.sum(1).tolist()
    assert all(got[k]["component_id"] == k and got[k]["kept"] and not got[k]["n_links"] for k in range(len(rows), len(rows) + 7))


def exact_links(ids, vectors, labels):
    """Links, and the smallest id of each component, by comparing all pairs."""
    n = len(ids)
    u = [np.asarray(v) / np.linalg.norm(v) for v in vectors]
    hit = [[i != j and labels[i] == labels[j] and len(u[i]) == len(u[j]) and float(u[i] @ u[j]) >= 0.93 for j in range(n)] for i in range(n)]
    low = list(ids)
    for _ in range(n):
        low = [min([low[i], *[low[j] for j in range(n) if hit[i][j]]]) for i in range(n)]
    return sorted(zip(ids, map(sum, hit), low, [i == c for i, c in zip(ids, low)]))


def test_near_duplicates_mixed_lengths_repeated_ids_and_clashing_columns(spark):
    rng = np.random.default_rng(8)
    rows = []
    for d in (1, 2, 5, 64):
        base = rng.normal(size=(6, d))
        for k in range(18):
            rows.append((len(rows), (base[k % 6] + rng.normal(size=d) * 0.15).tolist(), k % 2))
    rows += [(3, rows[40][1], 0), (60, rows[60][1], rows[60][2]), (61, [2 * x for x in rows[60][1]], rows[60][2])]
    # on the threshold itself, a hair above and below, and a squared length beyond the largest double
    c = 0.93
    rows += [(200, [1.0, 0.0, 0.0], 5), (201, [c + 1e-9, math.sqrt(1 - (c + 1e-9) ** 2), 0.0], 5), (202, [c - 1e-9, -math.sqrt(1 - (c - 1e-9) ** 2), 0.0], 5)]
    want = exact_links([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
    null = [(None, rows[0][1], 0), (None, None, None), (300, [1e300, 1e300, 1e300, 0.0], 9), (301, [1e300, 1e300, 1e300, 1e298], 9)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + null], "vec_id long, embedding array<double>, label int, eid string, copies int")
    got = [tuple(r) for r in near_dedup.near_duplicates(df).collect()]
    assert sorted(r for r in got if r[0] is not None and r[0] < 300) == want
    assert sorted(r for r in got if r[0] is not None and r[0] >= 300) == [(300, 1, 300, True), (301, 1, 300, False)]
    assert [r for r in got if r[0] is None] == [(None, 0, None, True)] * 2
    assert near_dedup.near_duplicates(df.where("vec_id < 0")).collect() == []


def test_near_duplicates_in_a_cell_of_many_blocks(spark):
    rng = np.random.default_rng(9)
    n, d = 1500, 64
    base = rng.normal(size=d)
    v = base + rng.normal(size=(n, d)) * 0.2
    df = spark.createDataFrame([(k, x.tolist(), 1) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    links = (u @ u.T >= 0.93).sum(1) - 1
    got = {r["vec_id"]: r for r in near_dedup.near_duplicates(df).collect()}
    # the tables are set for a recall of 0.9995 at the threshold; none is linked in excess
    assert all(got[k]["n_links"] <= links[k] for k in range(n))
    assert sum(got[k]["n_links"] for k in range(n)) >= 0.9995 * links.sum()
    assert {got[k]["component_id"] for k in range(n)} == {0}


def test_nearest_against_brute_force(spark):
    df, rows = vectors(spark)
    v = np.array([r[1] for r in rows])
    s = v @ v.T
    got: dict = {}
    for r in ann.nearest(df.where("vec_id <> 304"), F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert sorted(got) == list(range(0, len(rows), 20))
    for q, found in got.items():
        assert found == sorted((k for k in range(len(rows)) if k != q), key=lambda k: (-s[q, k], k))[:5]
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_url_rules(spark):
    urls = [None, "", "no scheme", "https://A.Example.ORG/es/x?q", "http://example.org/en/12", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/fr", "http://notorg/", "ftp://org", "http://casino-win.example.net/de/1", "http://x.com/de/1#a", "http://spam-farm.example.org/"]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)], "page_id long, url string, host string")
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, url_filter.standard_rules()).orderBy("page_id").collect()]
    assert got[:3] == [("", "", None, "allow")] * 3
    assert got[3] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert [g[2] for g in got[4:]] == ["example.org/en/1", "org/", "com/fr/", None, None, None, None, "com/de/", "org/"]
    assert [g[3] for g in got[4:]] == ["block", "allow", "allow", "allow", "allow", "allow", "block", "block", "allow"]
    old = url_filter.BROADCAST_RULES
    try:
        url_filter.BROADCAST_RULES = 0
        joined = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, url_filter.standard_rules()).orderBy("page_id").collect()]
    finally:
        url_filter.BROADCAST_RULES = old
    assert joined == got


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.1"
    out = quality_fm.op5_quality(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    assert (out.predicted == out.quality).mean() > 0.97
    empty = quality_fm.score(docs(spark), quality_fm.fit([], np.empty(0)))
    assert {r["score"] for r in empty.collect()} == {0.5}


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    size = quality_fm.WORD_SLOTS + len(quality_fm.STATISTICS)
    m = quality_fm.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 3)))
    at, x = quality_fm.features("some words to score", {})
    pairs = sum((m.factors[i] @ m.factors[j]) * a * b for (i, a), (j, b) in itertools.combinations(zip(at, x), 2))
    assert np.isclose(m.margins([(at, x)])[0], 0.3 + (m.linear[at] * x).sum() + pairs)


def test_toxicity(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts, labels = [None, ""], [(0, 0), (1, None)]
    for k in range(2, 402):
        w = [word() for _ in range(60)]
        if k % 5 == 0:
            for _ in range(rng.randint(1, 5)):
                w[rng.randrange(60)] = "zorg" + word()[:2]
        texts.append(" ".join(w))
        labels.append((k, int(k % 5 == 0)))
    d = docs(spark, texts)
    model = toxicity.train(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert any(s.startswith("zor") for s in model.words) and (np.diff(model.thresholds) >= 0).all()
    got = {r["doc_id"]: r for r in toxicity.rate(d, model).collect()}
    assert all(got[k]["toxic"] == (k % 5 == 0 and k > 1) for k in got)
    assert all(0 <= r["severity"] <= 3 for r in got.values())
    none = toxicity.train(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not any(r["toxic"] for r in toxicity.rate(d, none).collect())


PAGE = """<html><body><nav><ul><li><a href=a>Home</a></li></ul></nav><div class="ad">Buy now.</div><article><h1>A &amp; B</h1><p>First  line
goes here, and it is long enough to be read.<p>Second <b>bold</b> one.<ul><li>item one</li><li>item two</li></ul></article>
<section id="comments"><div class="comment"><p>Nice text, thanks.</p></div></section><footer>&copy; x</footer><script>var a="</p>";</script></body></html>"""


def test_html(spark):
    trees = html_extract.train()
    assert html_extract.main_text(PAGE, trees) == "A & B\nFirst line goes here, and it is long enough to be read.\nSecond bold one.\nitem one\nitem two"
    pages = spark.createDataFrame([(1, PAGE, "x"), (2, None, "x"), (3, "", "x"), (4, "just &lt;text&gt;", "x")], "page_id long, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract(pages, trees).collect()}
    assert got[2] == got[3] == ("", 0) and got[4] == ("just <text>", 11) and got[1][1] == len(got[1][0])


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{d}/documents.parquet")
    current = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, d)
        assert out.columns == source.columns
        out.write.parquet(str(tmp_path / name))
        current = spark.read.parquet(str(tmp_path / name))
        assert 0 < current.count() <= source.count()
    assert corpus_pipeline.run(spark, d).select("doc_id").distinct().count() == current.count()


def test_nearest_meets_rows_in_blocks_of_queries(spark, monkeypatch):
    """No task gets all queries, and the results are those of one block."""
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(k, [float(x) for x in rng.normal(size=8)]) for k in range(200)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "QUERY_BLOCK", 10_000)
    one = sorted(map(tuple, ann.nearest(df, F.col("vec_id") % 2 == 0, 5).collect()))
    monkeypatch.setattr(ann, "QUERY_BLOCK", 10)
    many = ann.nearest(df, F.col("vec_id") % 2 == 0, 5)
    assert sorted(map(tuple, many.collect())) == one and len(one) == 500
    assert "to_block" in many._jdf.queryExecution().toString()


def test_siblings_of_a_tag_are_counted_at_any_size():
    for n in (3, 300):
        nodes = html_extract.elements(html_extract.parse("<div>" + "<p>word</p>" * n + "<aside>x</aside></div>"))
        x = html_extract.features(nodes)
        assert {(m.tag, int(x[m.order, -2])) for m in nodes[2:]} == {("p", n), ("aside", 1)}


def test_formulas_and_objects_are_read():
    page = "<article><p>Let <math><mi>x</mi></math> be as in <object>the figure</object>, and so on for a while.</p></article>"
    assert html_extract.main_text(page, html_extract.train()) == "Let x be as in the figure, and so on for a while."


def test_url_within_a_url_has_no_path_of_its_own(spark):
    urls = ["http://example.org?u=http://x.org/en/1", "http://example.org#http://x.org/en/1", "http://example.org", "http://a.com/b?u=http://example.org/en/1", "http://://x.org/en/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r["host"], r["path"], r["rule"]) for r in url_filter.judge(df, url_filter.standard_rules()).orderBy("page_id").collect()]
    assert got == [("example.org", "", None), ("example.org", "", None), ("example.org", "", None), ("a.com", "/b", None), (":", "//x.org/en/1", None)]


def test_url_words_beside_others_and_empty_table(spark):
    import duckdb

    block = ["http://mega-casino.net/", "https://BETS24.com", "http://spam2farm.co.uk/x", "http://a.xxx.b/", "http://x_poker.com?a"]
    allow = ["http://dairy-farm.com/", "http://adsorb.com/", "http://alphabet.com", "http://x.porn/", "http://news.com/casino/", "http://my-casino.org/"]
    df = spark.createDataFrame(list(enumerate(block + allow)), "page_id long, url string")
    got = [tuple(r) for r in url_filter.judge(df, url_filter.standard_rules()).select("page_id", "host", "path", "rule", "verdict").orderBy("page_id").collect()]
    assert [g[4] for g in got] == ["block"] * len(block) + ["allow"] * len(allow)
    pages = df.toPandas()  # noqa: F841  read by the SQL
    assert sorted(duckdb.sql(url_filter.op4_sql()).fetchall()) == got
    assert url_filter.judge(df.where("page_id < 0"), url_filter.standard_rules()).collect() == []


def test_special_token_in_a_text_is_what_the_library_makes_of_it():
    from tokenizers import Tokenizer

    for name, spaced in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        k, e = Tokenizer.from_file(P.path(name)), token_store.Encoder(P.path(name), spaced)
        for t in ("a <|endoftext|> b", "x<|endoftext|>", "< |endoftext|>", "<|ENDOFTEXT|> plain words"):
            assert np.frombuffer(e([t])[0], "<u4").tolist() == k.encode(t, add_special_tokens=False).ids


def test_lookup_gives_every_occurrence(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (None, "x"), (None, "x"), (5, "y")], "doc_id long, text string")
    path = str(tmp_path / "s")
    token_store.write(d, path, P.path("byte_bpe_50k.json"), 2)
    got = token_store.lookup(spark.read.parquet(path), spark.createDataFrame([(1,), (3,), (5,), (None,)], "doc_id long")).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 1, 5]


def test_articles_without_names_and_deep_pages():
    import time

    trees, prose = html_extract.train(), "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod. " * 33
    assert html_extract.main_text(f"<nav><a href=/>Home</a><a href=/b>About</a></nav><div>{prose}</div>", trees) == prose.strip()
    paragraphs = "".join(f"<div>{prose[:300]}</div>" for _ in range(30))
    assert html_extract.main_text(f"<div>{paragraphs}</div>", trees) == "\n".join([prose[:300].strip()] * 30)
    began = time.time()
    html_extract.main_text("<div>" + "<b>x" * 8000 + "<p>y</p>" * 500 + "</i>" * 8000, trees)
    assert time.time() - began < 10
    for broken in ("<", "<div", "</p></p>", "<p>a<p>b</div></table>c", "&#x110000; &bogus;", "<script>if (a<b) {"):
        html_extract.main_text(broken, trees)


def test_repeated_rows_spread_over_packing_groups(spark):
    rows = spark.range(40_000).selectExpr("cast(null as long) doc_id", "0 piece", "0L ids_crc32", "600L length")
    got = packing.pack(rows, "length", ["doc_id", "piece", "ids_crc32"]).groupBy("sequence_id").agg({"length": "sum", "*": "count"}).collect()
    assert sum(r["count(1)"] for r in got) == 40_000 and max(r["sum(length)"] for r in got) <= 2048


@pytest.mark.parametrize("call", [
    lambda s, d: bpe.encode(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    lambda s, d: jaccard.join(d),
    lambda s, d: packing.packed_documents(d),
])
def test_empty_table(spark, tmp_path, call):
    assert call(spark, stored(docs(spark, []), tmp_path)).count() == 0


def test_jaccard_index_rows_without_a_partner_do_not_travel():
    """Of a list's rows those stay that another row may be linked to; the lists at both ends may go on, and stay whole."""
    rng = np.random.default_rng(3)
    token = np.sort(rng.integers(0, 60, 300))
    n = rng.integers(20, 400, 300).astype("i4")
    delta = rng.random(300) < 0.3
    dn = np.where(delta, rng.integers(1, 20, 300), n).astype("i4")
    pos = rng.integers(0, np.maximum(1, n // 8)).astype("i4")
    w = np.where(delta, 190 * dn.astype("i8") - 10 * n, 180 * n.astype("i8"))
    cap = 2 * 190 * (dn.astype("i8") - pos) - w
    kept = jaccard.partnered(token, n, dn, pos, delta, 90)
    for i in range(300):
        other = (token == token[i]) & (np.arange(300) != i)
        linked = (other & (w <= cap[i]) & (w[i] <= cap)).any()
        assert kept[i] or not linked
        if token[i] not in (token[0], token[-1]) and not ((w[other] <= cap[i]).any() and (w[i] <= cap[other]).any()):
            assert not kept[i]
    assert kept.mean() < 0.8


def test_jaccard_of_a_large_group_of_near_copies(spark):
    """A group whose members differ from their head, and some only from each other: against brute force."""
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            w[rng.choice([rng.randrange(120), 7, 50])] = rng.choice(["new" + str(rng.randint(0, 9)), "other"])
        texts.append(" ".join(w))
    sets = brute_sets(texts, 3)
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and label[a] != label[b]:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join(docs(spark, texts)).collect()}
    assert got == dict(enumerate(label)) and len(set(label)) > 3
