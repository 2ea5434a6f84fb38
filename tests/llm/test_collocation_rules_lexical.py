"""Phrase mining, the rule ensemble and lexical search against brute force, and their edge cases."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetspark.llm import collocation, flat, lexical, rules
from fleetspark.llm.common import stored, table
from fleetspark.plans.verify import compare, duck

from ..conftest import SF_SMALL
from .test_operators import odd  # noqa: F401

SF_MID = "/root/testdata/sf0.01"


def test_flat_words():
    texts = ["Ab, c\tD", "", None, "é!é x", " ", "end", "Z" * 70_000 + " z"]
    f = flat.FlatWords(pa.array([x or "" for x in texts]), collocation.CLASSES)
    words = f.words.to_pylist()
    got: dict = {}
    for c, d, p in zip(f.codes, f.doc, f.piece):
        got.setdefault(int(d), {}).setdefault(int(p), []).append(words[c])
    assert {d: list(p.values()) for d, p in got.items()} == {0: [["ab"], ["c", "d"]], 3: [["é"], ["é", "x"]], 5: [["end"]], 6: [["z" * 70_000, "z"]]}
    part = pa.array(["zero", "one two", "three"]).slice(1, 2)
    assert flat.FlatWords(part, collocation.CLASSES).words.to_pylist() == ["one", "two", "three"]
    assert list(flat.cuts(np.array([5, 1, 1, 9, 2]), 6)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    for a in (np.arange(7, dtype=np.int32), np.empty(0, np.int32)):
        assert flat.unpack(flat.pack(a), np.int32).tolist() == a.tolist()


def brute_phrases(rows, min_count, max_words, top, keep_percent):
    f: dict = {}
    n: Counter = Counter()
    for lang, text in rows:
        lang, c = lang or "und", None
        c = f.setdefault(lang, Counter())
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= keep_percent * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, r, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("max_words,block_bytes,top", [(2, 1 << 20, 2000), (3, 300, 2000), (4, 90, 25)])
def test_collocations_against_brute_force(spark, odd, max_words, block_bytes, top):  # noqa: F811
    rng = np.random.default_rng(max_words)
    words = ["a", "B", "b", "c", "d\x01", "d", "é", "of", "the", "x-y"]
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 60)), p=[.2, .1, .1, .1, .05, .05, .1, .1, .1, .1]))
             + str(rng.choice(["", ".", ",\n", "\r", " \t"])) * 2 + " of the a of the a", ["en", "de", None][i % 3]) for i in range(90)]
    extra = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    df = spark.createDataFrame([(i, t, g, 0, "clash") for i, t, g in rows + extra], "doc_id long, text string, lang string, n long, phrase string").repartition(3)
    got = collocation.collocations(df, min_count=4, max_words=max_words, top=top, block_bytes=block_bytes).collect()
    want = brute_phrases([(g, t) for _, t, g in rows + extra], 4, max_words, top, 50)
    assert {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want and len(want) > 40


def test_collocation_scores_beyond_64_bits(spark):
    a, left, right = 991_000_000_000_007, 993_100_000_000_001, 999_000_000_000_000_003
    row = spark.createDataFrame([(a, [left], [right])], "a long, l array<long>, r array<long>")
    got = row.select(F.expr(f"transform(arrays_zip(l, r), x -> {collocation.SCORE})").alias("s")).first().s
    assert got == [10**6 * a * a // (left * right)]


def test_collocations_of_nothing(spark, odd):  # noqa: F811
    assert collocation.collocations(odd.where("false")).isEmpty()
    assert collocation.collocations(odd.where("doc_id in (1, 2, 3, 10)")).isEmpty()
    with pytest.raises(ValueError):
        collocation.collocations(odd, max_words=1)


# --- rule ensemble ---------------------------------------------------------------


def test_text_statistics():
    t = ["The cat. THE cat! 12 | | x", "", "la la la\nla la la\n\nla la", "été É", "\x85 word"]
    got = {s: v.tolist() for s, v in zip(rules.STATISTICS, rules.text_statistics(pa.array(t)))}
    assert got["n_words"] == [8, 0, 8, 2, 2]
    assert got["upper_share"] == [4 / 13, 0, 0, 0, 0] and got["bars_per_word"][0] == 2 / 8 and got["bangs_per_word"][0] == 1 / 8
    assert got["digit_share"][0] == 2 / 26 and got["stops_per_word"][0] == 1 / 8
    assert got["distinct_share"][2] == 1 / 8 and got["top_word_share"][2] == 1 and got["run_share"][2] == 7 / 8 and got["run_share"][0] == 1 / 8
    assert got["dup_line_share"][2] == 1 / 3 and got["words_per_line"][2] == 8 / 3
    assert got["other_letters_share"][3] == 3 / 4 and got["short_share"][0] == 4 / 8
    assert all(len(v) == 5 and np.isfinite(v).all() for v in got.values())
    assert [len(v) for v in rules.text_statistics(pa.array([], pa.string()))] == [0] * len(rules.STATISTICS)


def test_tree_rules():
    text = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=16
  Tree 0 (weight 1.0):
    If (feature 0 <= 5.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      If (feature 0 <= 1.0E-4)
       Predict: 1.0
      Else (feature 0 > 1.0E-4)
       Predict: 0.0
    Else (feature 0 > 5.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 0 <= 5.5)
     Predict: 0.0
    Else (feature 0 > 5.5)
     Predict: 1.0
"""
    inf = math.inf
    assert rules.tree_rules(text) == [((0, -inf, 5.5),), ((0, -inf, 5.5), (2, -inf, 0.25)), ((0, -inf, 5.5), (2, 0.25, inf)),
                                      ((0, -inf, 1e-4), (2, 0.25, inf)), ((0, 1e-4, 5.5), (2, 0.25, inf))]


@pytest.fixture(scope="module")
def fitted(spark):
    stats = stored(rules.statistics(table(spark, SF_MID, "documents")), "stats")
    return stats, rules.train(stats, table(spark, SF_MID, "labels"))


def test_rule_ensemble_held_out(spark, fitted):
    stats, model = fitted
    p = rules.scored(stats, model).join(table(spark, SF_MID, "labels"), "doc_id").where("held_out").toPandas()
    good, bad = p[p.quality == 1], p[p.quality == 0]
    assert len(bad) >= 15 and (bad.predicted == 0).mean() >= 0.9 and (good.predicted == 1).mean() >= 0.95
    assert ((p.score >= 0) & (p.score <= 1)).all()


def test_rules_are_what_the_column_says(spark, fitted):
    stats, model = fitted
    assert 3 <= len(model.rules) <= 150 and len(model.describe()) == len(model.rules)
    rows = rules.scored(stats, model).toPandas().merge(stats.toPandas(), on="doc_id")
    for r in rows.head(50).to_dict("records"):
        z = model.intercept + sum(w for rule, w in model.rules if all(lo < r[rules.STATISTICS[s]] <= hi for s, lo, hi in rule))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def test_rule_ensemble_reruns_agree(spark, fitted):
    stats, model = fitted
    again = rules.train(stats, table(spark, SF_MID, "labels"))
    assert [r for r, _ in again.rules] == [r for r, _ in model.rules]
    assert [w for _, w in again.rules] == pytest.approx([w for _, w in model.rules], rel=1e-6)


def test_rule_ensemble_odd(spark, odd, fitted):  # noqa: F811
    _, model = fitted
    d = odd.withColumn("n_words", F.lit("clash")).withColumn("score", F.lit(1))
    got = rules.scored(rules.statistics(d), model).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 10)}) == 1 and not any(r.held_out for r in got if r.doc_id is None)
    labels = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
    stats = rules.statistics(odd)
    for lab, want in ((labels(), {1.0}), (labels((1, 1, 0), (None, 0, 1)), {1.0}), (labels((1, 0, 0), (4, 0, 1), (5, None, 0)), {0.0})):
        assert {r.score for r in rules.scored(stats, rules.train(stats, lab)).collect()} == want
    assert rules.scored(rules.statistics(odd.where("false")), model).isEmpty()


def test_held_out_rows_train_nothing(spark, odd):  # noqa: F811
    import zlib
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    d = spark.createDataFrame([(i, "word " * 9) for i in range(200)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i not in held)) for i in range(200)], "doc_id long, quality int")
    stats = rules.statistics(d)
    assert rules.train(stats, lab).rules == [] and {r.score for r in rules.scored(stats, rules.train(stats, lab)).collect()} == {1.0}
    assert {r.doc_id for r in rules.scored(stats, rules.train(stats, lab)).where("held_out").collect()} == set(held)


# --- lexical search ----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text or ""))


def brute_search(docs, items, top):
    bags = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs if terms_of(t)]
    n, total = len(bags), sum(x for _, _, x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in dict.fromkeys(items):
        q, rows = Counter(terms_of(text)), []
        for i, b, size in bags:
            m = 75 + 25 * size * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in q.items() if t in b)
            if s > 0:
                rows.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes,batch,top", [(1 << 20, 256, 20), (400, 7, 5)])
def test_lexical_search_against_brute_force(spark, odd, block_bytes, batch, top):  # noqa: F811
    rng = np.random.default_rng(batch)
    words = [f"w{i}" for i in range(150)] + ["É", "Ünder", "12", "a'b", "x_y"]
    p = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=p / p.sum()))
    docs = [(r.doc_id, r.text) for r in odd.collect()] + [(100 + i // 2, text(int(rng.integers(1, 400)))) for i in range(150)] + [(None, text(30))]
    items = [(i, text(int(rng.integers(1, 25)))) for i in range(30)] + [(3, "w1 w2 w2"), (40, None), (41, " ! "), (42, "w0 W0 w0"), (42, "w0 W0 w0"), (43, "unknown")]
    d = spark.createDataFrame([(i, t, 5, "clash") for i, t in docs], "doc_id long, text string, score int, terms string").repartition(3)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, q int")
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.search(d, q, top=top, batch=batch, block_bytes=block_bytes).collect()]
    assert sorted(got, key=str) == brute_search(docs, items, top) and len(got) > 30 * top * 0.9


def test_bounds_hold_and_spare_work(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    f = flat.FlatWords(pa.array([t for _, t in docs]), lexical.TERMS_OF)
    key, tf = np.unique(f.doc.astype(np.int64) << 32 | f.codes, return_counts=True)
    owner, code = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
    size = np.bincount(f.doc, minlength=len(docs))
    m = 75 + 25 * size * len(docs) // size.sum()
    widths, s = lexical.sketch(owner, lexical.term_hashes(f.words).astype(np.int64)[code], lexical.impacts(tf, m[owner]), len(docs))
    batch = lexical.Batch([(i, list(c), [1000 * x for x in c.values()]) for i, c in ((i, Counter(terms_of(t))) for i, t in items)])
    bound = batch.bounds(widths, s)
    assert (widths & (widths - 1) == 0).all()
    best = [lexical.Best(20) for _ in items]
    scored = lexical.search_block(batch, best, np.array([i for i, _ in docs]), f.words, owner, code, tf.astype(np.int32), m, widths, s)
    words = {w: i for i, w in enumerate(f.words.to_pylist())}
    for k, (_, text) in enumerate(items):
        exact = np.zeros(len(docs), np.int64)
        for t, c in Counter(terms_of(text)).items():
            if t in words:
                at = code == words[t]
                np.add.at(exact, owner[at], 1000 * c * lexical.impacts(tf[at], m[owner[at]]))
        assert (bound[:, k] >= exact).all()
        assert best[k].score.tolist() == sorted(exact[exact > 0], reverse=True)[:20]
    assert scored < 0.8 * len(items) * len(docs)


def test_lexical_search_of_nothing(spark, odd):  # noqa: F811
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    assert lexical.search(odd.where("false"), items).isEmpty()
    assert lexical.search(odd.where("doc_id in (1, 2, 3)"), items).isEmpty()
    assert lexical.search(odd, items.where("false")).isEmpty()
    assert lexical.search(odd, items.where("item_id = 2")).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("name", ["op11_collocations", "op13_lexical_search"])
def test_sql_on_more_rows(spark, name):
    from fleetspark.llm.queries import QUERIES, SQL
    r = compare(QUERIES[name](spark, SF_MID), SQL[name], duck(SF_MID))
    assert r["ok"], r
