"""Corpus operators on small fixtures: brute force, round trips, SQL texts, held-out
labels, and the edge cases of the docstrings (nulls, empty tables, repeated rows, extra columns)."""

import hashlib
import html as entities
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import (ann, html_extract, license_scan, materialise, mixing, ngram_join, packing, quality, suffix_dedup, tokens,
                            toxicity)
from fleetspark.llm.common import shared_folder
from fleetspark.llm.queries import QUERIES, SQL
from fleetspark.plans.verify import compare, duck

from ..conftest import SF_SMALL

DDL = "doc_id long, text string, lang string, source string, n_chars long, token string, h long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three four five six " * 40), (5, "one two three four five six " * 40),
            (6, "one two three four five six " * 40), (None, "no id here"), (7, "x" * 300), (8, "y" + "x" * 300),
            (9, "é ü idiot \U0001f600 'twas it's 12 %% " * 30), (10, None)]
    return spark.createDataFrame([(i, t, "en", None if (i or 0) % 3 == 0 else f"s{(i or 0) % 4}", len(t or ""), "clash", 1) for i, t in rows], DDL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def test_trees_inside_leaves():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) * 3
    m = centres[rng.integers(0, 40, 5000)] + rng.normal(size=(5000, 16))
    queries = centres[rng.integers(0, 40, 300)] + rng.normal(size=(300, 16))
    exact = ann.nearest_in(m, queries, 11, subtree=10_000)
    for q, (at, dist) in zip(queries, exact):
        d = np.sqrt(((m - q) ** 2).sum(1))
        assert sorted(at) == sorted(np.argsort(d)[:11]) and np.allclose(sorted(dist), np.sort(d)[:11])
    seen, real = [], ann.Tree.visits
    ann.Tree.visits = lambda self, q: (seen.append(x) or x for x in real(self, q))
    try:
        found = ann.nearest_in(m, queries, 11, subtree=1000)
    finally:
        ann.Tree.visits = real
    hit = sum(len(set(a) & set(b)) for (a, _), (b, _) in zip(exact, found))
    assert hit >= 0.97 * 11 * len(queries)
    leaves = ann.Tree(m, max_leaves=5000 // ann.LEAF, leaf=ann.LEAF).leaves
    assert len(seen) < 0.8 * leaves * len(queries)
    few = ann.nearest_in(np.ones((3, 4)), np.ones((200, 4)), 11, subtree=1)
    assert all(sorted(at) == [0, 1, 2] for at, _ in few)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    r = compare(QUERIES[name](spark, SF_SMALL), SQL[name], duck(SF_SMALL))
    assert r["ok"], r


def test_word_ids_equal_whole_texts(docs, odd):
    enc = tokens.ChunkEncoder(tokens.default_vocabulary())
    texts = [r.text or "" for r in docs.limit(40).union(odd.select(docs.columns)).collect()] + ["ΣΑΣ İx ﬁ½ x\x85y a\x1cb 中文 don't I'LL 's"]
    for t, x in zip(texts, enc.ids(texts, None)):
        assert np.frombuffer(x, "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_shortest_pack_first_places_every_length():
    hist = {2048: 3, 1000: 5, 700: 4, 300: 11, 3: 900, 1: 2}
    got: dict[int, int] = {}
    for packs, pattern in packing.shortest_pack_first(hist):
        assert sum(n * k for n, k in pattern) <= 2048
        for n, k in pattern:
            got[n] = got.get(n, 0) + packs * k
    assert got == hist


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    p = packing.pack(df, with_ids=True).toPandas()
    assert all(zlib.crc32(np.array(x, "<u4").tobytes()) == c for x, c in zip(p.ids, p.ids_crc32))
    assert p.length.sum() == p[p.start == 0].doc_tokens.sum()
    for _, g in p.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
    assert sorted(p.sequence_id.unique()) == list(range(p.sequence_id.nunique()))


def test_training_order_round_trip(spark, odd):
    for n in (1, 2, 5, 17, 300):
        slots = materialise.feistel_array(np.arange(n), n)
        assert sorted(slots) == list(range(n)) and slots.tolist() == [materialise.feistel(i, n) for i in range(n)]
    path = shared_folder(spark, "test-order")
    index = materialise.materialise(odd, path, seq_len=16, per_shard=20).toPandas().set_index("slot")
    got = materialise.read_slots(spark, path, 5, 40, seq_len=16, per_shard=20).toPandas().set_index("slot").ids
    assert sorted(index.index) == list(range(len(index))) and sorted(got.index) == list(range(5, 45))
    assert all(zlib.crc32(np.array(ids, "<u4").tobytes()) == index.ids_crc32[k] for k, ids in got.items())


def test_slots_of_nothing(spark, odd):
    path = shared_folder(spark, "test-none")
    materialise.materialise(odd.where("false"), path)
    assert materialise.read_slots(spark, path, 0, 10).isEmpty()


def test_tree_search_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    extra = [(10_000 + i, rows[0][1]) for i in range(30)] + [(20_000, None), (20_001, [0.0] * 64), (20_002, [float("nan")] * 64), (None, rows[1][1])]
    df = spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "c") for i, v in rows + extra], "vec_id long, embedding array<float>, h1 string")
    ids = np.array([i for i, _ in rows + extra[:30]])
    x = np.array([v for _, v in rows + extra[:30]], dtype=np.float32).astype(float)
    got = ann.search(df, F.col("vec_id") % 100 == 0).toPandas()
    hit = 0
    queries = [i for i in ids if i % 100 == 0]
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = np.lexsort([ids, d])[:10]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and (np.diff(mine.score) >= 0).all()
        hit += len(set(ids[best]) & set(mine.vec_id))
    assert hit >= 9 * len(queries)


def test_html(spark):
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li>Home</ul></nav><div class=ad>Buy</div>"
            "<article><h1>A &amp; B</h1><p>one\n two<p><b>three<br>four<div class='comments'>nice</div></article><footer>x</footer>")
    df = spark.createDataFrame([(1, "http://h.example/a", page, 1), (2, None, None, 1), (3, "x", "", 1)], "page_id long, url string, html string, path long")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract_pages(df).collect()}
    assert got == {1: ("A & B\none two\nthree four", 24), 2: ("", 0), 3: ("", 0)}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " " if "<br>" in x else "", x))).strip() for x in re.split(r"</?(?:p|h1)>", body)]
        want[r.page_id] = "\n".join(x for x in parts if x)
    assert {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()} == want


@pytest.mark.parametrize("page", [
    "<main><h1>T</h1><div class=content><p>{b}</p></div></main>",
    "<article><div class=intro><p>T</p></div><div class=body><p>{b}</p></div></article>",
    "<div class='layout no-sidebar'><article><p>T<p>{b}</article></div><div>(c) Example Ltd.</div>",
    "<div class=has-sidebar><div class=post><h1>T</h1><div class=text><p>{b}</div></div></div>",
    "<div class=layout-with-sidebar><div class=post><h1>T</h1><div class=text><p>{b}</div></div><div><p><a href=x>elsewhere</a></div></div>",
    "<main><h1>T</h1><div class=content><p>{b}</p></div><div class=site-footer>gone</div><div class='post comments'>gone</div></main>"])
def test_html_nested_layouts(spark, page):
    body = "word " * 200 + "end"
    df = spark.createDataFrame([(i, f"http://h.example/{i}", f"<html><body><nav>Home</nav>{page.format(b=body)}<footer>x</footer></body></html>")
                                for i in range(2)], "page_id long, url string, html string")
    assert [r.text for r in html_extract.extract_pages(df).collect()] == [f"T\n{body}"] * 2


@pytest.mark.parametrize("page,text", [
    ("<article><header><h1>T</h1><p>By A. Nother</p><nav><h2>In this part</h2></nav></header><p>{b}</p></article>", "T"),
    ("<div class=post><div class=post-header><div><h1>T</h1></div><span>1 May</span></div><p>{b}</p></div>", "T"),
    ("<main><header class='article-header share'><h1>gone</h1></header><h1>T</h1><p>{b}</p></main>", "T"),
    ("<header><h1>Site</h1></header><article><h1>T</h1><p>{b}</p><footer><h2>gone</h2></footer></article>", "T"),
    ("<article><header hidden><h1>gone</h1></header><h1>T</h1><p>{b}</p></article>", "T")])
def test_html_headings_of_an_articles_own_header(page, text):
    body = "word " * 200 + "end"
    assert html_extract.extract(f"<html><body>{page.format(b=body)}</body></html>", None)[0] == f"{text}\n{body}"


def test_html_formulas_stay():
    page = "<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</article>"
    assert html_extract.extract(page, None)[0] == "so x=1 holds"


def brute_dedup(rows, size):
    seen, out = set(), {}
    for i, t in rows:
        raw, cut = t.encode(), np.zeros(len(t.encode()), bool)
        for k in range(len(raw) - size + 1):
            if raw[k:k + size] in seen:
                cut[k:k + size] = True
            seen.add(raw[k:k + size])
        out[i] = (int(cut.sum()), hashlib.sha256(np.frombuffer(raw, np.uint8)[~cut].tobytes()).hexdigest())
    return out


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.integers(0, int(rng.integers(1, 5)) + 1, int(rng.integers(1, 300))).astype(np.uint8)
        sa, raw = suffix_dedup.two_stage_suffix_array(a, 100), a.tobytes()
        keys = [raw[i:i + 100] for i in sa]
        assert sorted(sa) == list(range(len(a))) and keys == sorted(keys)


@pytest.mark.parametrize("split", [256, 1])
def test_suffix_dedup_against_brute_force(docs, split):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.dedup(docs, split=split).collect()} == brute_dedup(rows, 100)


def test_suffix_dedup_odd(odd):
    assert suffix_dedup.dedup(odd).count() == 12
    one = odd.where("doc_id in (7, 8)")
    rows = sorted((r.doc_id, r.text) for r in one.collect())
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.dedup(one).collect()} == brute_dedup(rows, 100)


def brute_join(rows, k, num, den):
    sets, root = {}, {}
    for i, t in rows:
        w = t.encode().lower().split()
        sets[i] = frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])
        root[i] = i
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and den * common >= num * len(sets[a] | sets[b]) and sets[b]:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k,num,split", [(3, 90, 200), (3, 90, 3), (5, 80, 4)])
def test_ngram_join_against_brute_force(docs, k, num, split):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(docs, k, num, 100, split=split).collect()}
    assert got == brute_join(rows, k, num, 100)


def brute_links(rows, k, num, den):
    """Per row the other documents whose set links with its own."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else []))
    texts = {(i, s) for (i, _), s in zip(rows, sets) if i is not None and s}
    return [(i, 0 if i is None or not s else sum((j, u) != (i, s) and den * len(s & u) >= num * len(s | u) for j, u in texts))
            for (i, _), s in zip(rows, sets)]


@pytest.mark.parametrize("chunk", [1000, 7])
def test_ngram_join_counts_every_link(spark, docs, odd, chunk):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    near = [[f"e{rng.integers(9)}" if rng.random() < 0.012 else w for w in words] for _ in range(60)]
    rows = [(r.doc_id, r.text) for r in docs.union(odd.select(docs.columns)).collect()] + [(10_000 + i, " ".join(w)) for i, w in enumerate(near)]
    rows += [(20_000, rows[-1][1]), (20_000, rows[-1][1]), (20_001, rows[-1][1]), (20_001, rows[-2][1])]
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100, split=20, chunk=chunk).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.n_links) for r in got), key=key) == sorted(brute_links(rows, 3, 90, 100), key=key)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_shingles_of_many_texts_at_once(monkeypatch, k):
    rng = np.random.default_rng(7)
    texts = ["", " ", "a", "a b", "A  b\n", "a b", "a\x1cb c d", "a\xa0b c d", "\u00c0B \u00e9 c", " x\ty\vz\f", "x", "y", "", "abcdefgh abcdefgh", "abcdefghi",
             "q" * 64, "Q" * 64, "q" * 65, "q" * 65 + " r", "a b c d e f a b c d e f", "A B C D E F"]
    texts += [" ".join(f"w{rng.integers(10 ** rng.integers(1, 12))}" for _ in range(rng.integers(1, 60))) for _ in range(300)]
    monkeypatch.setattr(ngram_join, "SLICE", 500)
    alone = []
    digest = ngram_join.xxhash.xxh64_intdigest
    monkeypatch.setattr(ngram_join.xxhash, "xxh64_intdigest", lambda w: alone.append(w) or digest(w))
    col = pa.concat_arrays([pa.array(["left out"]), pa.array(texts)])[1:]
    got = [s[i:j].tolist() for _, _, s, at in ngram_join.set_slices(col, k) for i, j in zip(at[:-1], at[1:])]
    assert alone == [b"q" * 65] * 2  # words of usual length are hashed together, not one by one
    name = {}
    for t, have in zip(texts, got, strict=True):
        w = t.encode().lower().split()
        want = set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else {tuple(w)} if w else set()
        assert have == sorted(set(have)) and len(have) == len(want)
        # equal sets, and only these, have equal hashes
        assert name.setdefault(frozenset(want), have) == have
    assert len({tuple(x) for x in name.values()}) == len(name)


def test_heavy_tokens_are_frequent_among_all_documents(spark):
    # every batch has frequent shingles of its own (five times each, 0.00125 of all documents); one is in all documents
    few = spark.createDataFrame([(i, f"a b c p{i // 5} q r w{i}") for i in range(4000)], "doc_id long, text string").repartitionByRange(40, "doc_id")
    assert ngram_join.heavy_tokens(few, 3).count() == 1


def test_ngram_join_odd(odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.classes(odd).collect()}
    assert (1, 0, 1) in got and (6, 6, 5) in got and (None, 1, None) in got and (4, 1, 4) in got


def test_license_scan_finds_the_usual_wordings(spark):
    lines = [("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
             ("CC-BY-ND-4.0", "This work is licensed under CC BY-ND 4.0."), ("CC-BY-SA-4.0", "Released under CC BY-SA 4.0."),
             ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."), ("LGPL-2.1", "Distributed under the GNU Lesser General Public License, version 2.1."),
             ("AGPL-3.0", "Licensed under the GNU Affero General Public License v3.0."), ("MIT", "Released under the MIT License."),
             ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Proprietary", "All rights reserved."),
             *license_scan.NOTICES]
    rows = [(i, f"some words before it\n{t}\nand some after it") for i, (_, t) in enumerate(lines)]
    got = {r.doc_id: (r.license, r.dice) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (lic, 1.0) for i, (lic, _) in enumerate(lines)}


def test_license_scan_finds_embedded_and_wrapped_notices(spark, docs):
    texts = {tid: body for tid, _, body in license_scan.TEMPLATES}
    prose = " ".join(r.text for r in docs.where("length(text) between 500 and 2000").orderBy("doc_id").limit(3).collect()).replace("\n", " ")
    header = lambda t: "\n".join(f" * {x}" for x in textwrap.wrap(texts[t], 80))
    rows = [(t, f"{prose}\n/*\n{header(t)}\n */\n{prose}") for t in (12, 13, 14, 15)] + [
        (4, f"{prose} {texts[4]} {prose}"), (10, f"One line of words before it. {texts[10]} And one line of words, to be longer."),
        (1, f"{prose}\n{texts[1]}\n{prose}"), (100, " ".join(f"{x} {prose}" for x in texts[14].split())), (101, prose)]
    got = {r.doc_id: (r.license, r.dice) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lic = {tid: x for tid, x, _ in license_scan.TEMPLATES}
    assert got == {t: (lic[t], 1.0) if t < 100 else (None, 0.0) for t, _ in rows}


def test_license_runs_against_brute_force(spark):
    rng = np.random.default_rng(3)
    templates = [(1, "A", "a b c a b d e f"), (2, "B", "c d e"), (3, "C", "b a b a c f e d b")]
    rows = [(i, " ".join(rng.choice(list("abcdefgh"), int(rng.integers(4, 60))))) for i in range(120)]
    rows += [(i + 500, f"x x {t[:9]} h {t[9:]} x x".replace(" ", "\n", 4)) for i, (_, _, t) in enumerate(templates)]

    def grams(w):
        return {*zip(w, w[1:])}

    def dice(a, b):
        return 2 * len(a & b) / (len(a) + len(b))

    want = {}
    bounds = {tid: longest for tid, _, _, _, longest, _ in license_scan.template_rows(templates, 0.8)}
    for i, t in rows:
        lines, w, hits = [x.split() for x in t.split("\n")], t.split(), []
        place = [k for k, x in enumerate(lines) for _ in x]
        units = [x for x in ([*lines, w] if len(lines) > 1 else [w]) if len(x) > 1]
        match = [(round(dice(grams(u), grams(b.split())), 6), -tid) for u in units for tid, _, b in templates if dice(grams(u), grams(b.split())) >= 0.8]
        assert all(len(set(place)) == 1 or len(x) == 1 or not any(dice(grams(x), grams(b.split())) >= 0.8 for _, _, b in templates) for x in lines)
        if not any(dice(grams(w), grams(b.split())) >= 0.8 for _, _, b in templates):
            for tid, _, b in templates:
                runs = [dice(grams(w[p:p + n + 1]), grams(b.split())) for p in range(len(w)) for n in range(1, bounds[tid] + 1) if p + n < len(w)]
                if max(runs, default=0) >= 0.8:
                    hits.append((round(max(runs), 6), -tid))
        best = max(match + hits, default=(0.0, None))
        want[i] = (len(match) + len(hits), best[0], best[1] and "ABC"[-best[1] - 1])
    got = {r.doc_id: (r.n_matches, r.dice, r.license) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()}
    assert got == want and sum(x[0] > 0 for x in want.values()) > 5


def test_toxicity_matches_misspelt_terms_and_tells_quotation():
    m = toxicity.Matcher(["worthless", "idiot"], ["lowei"])
    assert [m.match(w) for w in ("worthless", "wortles", "idiott", "idot", "loweisch", "harmless", "id")] == [3, 1, 1, 1, 2, 0, 0]
    direct, quoted = (toxicity.text_features(t, m)[0] for t in ("you are an idiot and more", 'they said "you are an idiot" and left'))
    assert direct[0] == 1 and quoted[0] == 0 and quoted[1] == 1


def test_toxicity_held_out(spark):
    r = toxicity.op8(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    p = r.where("lang = 'en'").toPandas() if "lang" in r.columns else r.toPandas()
    assert (p.predicted[p.toxic == 0] == 0).mean() > 0.98 and ((p.predicted == p.toxic)[p.held_out]).mean() > 0.9


@pytest.fixture(scope="module")
def toxic_model(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).toPandas()
    return toxicity.train(docs, labels), held


def scores(model, texts):
    m = toxicity.Matcher(model.words, model.stems, model.known)
    return model.score(np.array([toxicity.text_features(t or "", m)[0] for t in texts]))


def test_toxicity_finds_held_out_rows_and_spares_clean_ones(toxic_model):
    model, held = toxic_model
    s = scores(model, held.text)
    assert (s[held.toxic == 1] >= 0.5).mean() > 0.9 and (s[held.toxic == 0] >= 0.5).mean() < 0.005


def test_a_match_never_lowers_a_score(toxic_model):
    model, held = toxic_model
    assert (model.w >= 0).all() and model.w[toxicity.FEATURES.index("fuzzy_direct")] > 0
    clean = [t for t, y in zip(held.text, held.toxic) if not y and t][:60]
    plain, wrong, exact = (scores(model, [f"{t} {x}" for t in clean]) for x in ("you are a", "you are a worthles", "you are a worthless"))
    assert (wrong > plain).all() and (exact > plain).all()
    assert scores(model, ['they said "idiot" and left'])[0] < scores(model, ["you are an idiott"])[0] < scores(model, ["you are an idiot"])[0]


def test_misspelt_terms_are_found_through_the_automaton(toxic_model):
    """Ablation: toxic held-out texts with misspelt terms, with and without the weights of misspelt matches."""
    model, held = toxic_model
    m = toxicity.Matcher(model.words, model.stems)
    texts = [toxicity.misspelt(t, m) for t, y in zip(held.text, held.toxic) if y]
    blind = toxicity.ToxicityModel(model.words, model.stems, np.where(np.char.startswith(toxicity.FEATURES, "fuzzy"), 0, model.w), model.b, model.known)
    blind.w[toxicity.FEATURES.index("density")] = blind.w[toxicity.FEATURES.index("near")] = 0
    found, without = (float((scores(x, texts) >= 0.5).mean()) for x in (model, blind))
    assert found > 0.6 and found > without + 0.3, (found, without)


def test_toxicity_automaton_starts_anew():
    words = ["worthless", "idiot", "stupid"]
    small, large = toxicity.Matcher(words, []), toxicity.Matcher(words, [])
    rng = np.random.default_rng(0)
    tries = ["".join(rng.choice(list("wortheslidup"), 7)) for _ in range(400)] + words + ["idot", "stupidd", "worthles"]
    old, toxicity.MAX_STATES = toxicity.MAX_STATES, 30
    try:
        got = [small.match(w) for w in tries]
    finally:
        toxicity.MAX_STATES = old
    assert got == [large.match(w) for w in tries] and len(small.moves) < len(large.moves)


def test_quality(spark, odd):
    t = "a b c a b c\nx\nx\n \n#*"
    assert quality.base_counts(t, t.split()) == (9, 10, 2, 1, 6)
    r = quality.op9(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    assert (r.kept == (r.quality == 1)).mean() > 0.95
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.score(odd, quality.train(odd, labels)).count() == 12
    assert toxicity.score(odd, toxicity.train(odd, labels)).count() == 12


def test_mix_hits_targets(odd, docs):
    for df in (odd, docs):
        t = mixing.taken(df).toPandas()
        assert (t.taken <= 3 * t["size"]).all() and len(t) == df.count()
        assert t.taken.sum() == pytest.approx(t["size"].sum(), abs=40)


def test_empty_tables(spark, odd):
    none, labels = odd.where("false"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages, vectors = spark.createDataFrame([], "page_id long, url string, html string"), spark.createDataFrame([], "vec_id long, embedding array<float>")
    frames = [packing.pack(none), license_scan.scan(none), html_extract.extract_pages(pages), suffix_dedup.dedup(none), ngram_join.classes(none),
              toxicity.score(none, toxicity.train(none, labels)), quality.score(none, quality.train(none, labels)), mixing.taken(none),
              ann.search(vectors, F.col("vec_id") % 100 == 0), materialise.materialise(none, shared_folder(spark, "empty"))]
    assert [f.count() for f in frames] == [0] * len(frames)
