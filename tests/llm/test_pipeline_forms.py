"""The corpus pipeline and its stages against brute-force versions: null ids, repeated rows,
columns with the operators' own names, empty tables, very long texts."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetspark.llm import mixing, ngram_join, packing, suffix_dedup, tokens, toxicity

from ..conftest import SF_SMALL
from .test_operators import brute_dedup, brute_join

CLASH = ["predicted", "score", "_d", "_c", "_i", "_r", "_row", "_key", "rest", "n_removed", "n_terms", "k0", "doc", "th", "x", "h1", "h2", "rep", "size",
         "start", "taken", "component_id", "count", "_extra0_", "id", "token"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    own = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(90).collect()]
    near = " ".join(f"word{i}" for i in range(120))
    passage = "this very passage is found in several documents, and it is longer than a hundred bytes, so that it goes from all but one. "
    odd = [(1000, None, "en", "s1"), (1001, "", "en", None), (1002, near, "en", "s1"), (1003, near + " more", "en", "s2"), (1004, "x " + near, "en", "s1"),
           (1005, passage + "one " * 60, "en", "s1"), (1006, "two " * 60 + passage, "en", "s2"), (None, "no id, three times " * 9, "en", None),
           (None, "no id, three times " * 9, "en", None), (None, "no id, three times " * 9, "en", None), (None, "no id, once", "en", "s1"),
           (1007, "w" * 20_000 + " " + "v " * 20_000, "de", "s3"), (1008, "you idiot, you worthless idiot and moron, stupid scum", "en", "s1")]
    odd += [(2000 + i // 3, f"thrice number {i // 3} " + " ".join(f"t{i // 3}u{j}" for j in range(30)), "en", "s2") for i in range(15)]
    rng = np.random.default_rng(4)
    some = lambda n: [f"v{x}" for x in rng.integers(0, 400, n)]
    odd += [(3000 + i, " ".join([*some(12), "idiot" if i % 2 else "worthless", *some(12)]), "en", "s2") for i in range(60)]
    odd += [(3100 + i, " ".join(some(25)), "en", "s1") for i in range(60)]
    return [(i, t, g, s, len(t or ""), *range(len(CLASH))) for i, t, g, s in own + odd]


@pytest.fixture(scope="module")
def frame(spark, docs):
    return spark.createDataFrame(docs, DDL).repartition(3)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def labels(spark):
    own = [(3000 + i, 1, int(i < 60)) for i in range(60)] + [(3100 + i, 1, 0) for i in range(60)] + [(None, 1, 1), (1007, 1, 0), (1, 1, None)]
    return spark.createDataFrame(own, "doc_id long, quality int, toxic int")


def test_toxic_documents_go(spark, frame, docs, labels):
    model = toxicity.train(frame.select("doc_id", "text"), labels)
    m = toxicity.Matcher(model.words, model.stems, model.known)
    bad = lambda t: model.score(np.array([toxicity.text_features(t or "", m)[0]]))[0] >= 0.5
    got = toxicity.clean_documents(frame, labels)
    assert got.columns == frame.columns and rows(got) == sorted((r for r in docs if not bad(r[1])), key=str)


def test_one_document_of_each_group_stays(frame, docs):
    got = ngram_join.one_of_each(frame)
    assert got.columns == frame.columns
    known = [(i, t or "") for i, t, *_ in docs if i is not None]
    reach = brute_join(list(dict.fromkeys(known)), 5, 80, 100)  # ids are unique here but for equal rows
    want = list(dict.fromkeys(r for r in docs if r[0] is not None and reach[r[0]][1] == r[0])) + [r for r in docs if r[0] is None]
    assert rows(got) == sorted(want, key=str)
    assert sum(2000 <= (r[0] or 0) < 2005 for r in rows(got)) == 5


def test_of_two_texts_with_one_id_one_stays(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "g h i j k l"), (2, "m n o p q"), (None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    got = ngram_join.one_of_each(df).collect()
    assert sorted((r.doc_id or 0 for r in got)) == [0, 1, 2]


def test_repeated_passages_go(frame, docs):
    unique = [r for r in dict.fromkeys(docs) if r[0] is not None]
    ids = {r[0] for r in unique}
    got = {r.doc_id: r for r in suffix_dedup.deduped_documents(frame.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    brute = brute_dedup(sorted((r[0], r[1] or "") for r in unique), 100)
    assert set(got) == ids
    for r in unique:
        left = got[r[0]].text
        assert got[r[0]].n_chars == len(left) and tuple(got[r[0]])[5:] == r[5:]
        if left.isascii():
            assert hashlib.sha256(left.encode()).hexdigest() == brute[r[0]][1]


def mix_copies(docs):
    """Copies of each row, by the rules in plain Python."""
    import hashlib as h
    import re
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in docs]
    sources = sorted({r[3] for r in docs}, key=lambda s: (s is None, s or ""))
    total, own = sum(size), {s: sum(n for n, r in zip(size, docs) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, left = {}, set(sources)
    while True:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 3 * own[s]]
        if not over:
            target |= share
            break
        target |= {s: 3 * own[s] for s in over}
        left -= set(over)
        if not left:
            break
    out = [0] * len(docs)
    for s in sources:
        line = [(h.md5(f"{r[0] if r[0] is not None else h.md5((r[1] or '').encode()).hexdigest()}|{s or ''}".encode()).hexdigest(), i)
                for i, r in enumerate(docs) if r[3] == s]
        at, end = 0, round(target[s])
        for _, i in sorted(line):
            got = sum(max(0, min(at + e * own[s] + size[i], end) - at - e * own[s]) for e in range(3))
            out[i] = int(np.floor(got / size[i] + 0.5)) if size[i] else 0
            at += size[i]
    return out


def test_mixed_documents(frame, docs):
    got = mixing.mixed_documents(frame)
    want = [r for r, n in zip(docs, mix_copies(docs)) for _ in range(n)]
    assert got.columns == frame.columns and rows(got) == sorted(want, key=str)


def test_clashing_columns_in_packing(frame, docs):
    p = packing.pack(frame).toPandas()
    assert p[p.start == 0].shape[0] == len(docs)
    assert p.columns[:7].tolist() == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_empty_tables(spark, frame, labels):
    none = frame.where("false")
    for out in (toxicity.clean_documents(none, labels), ngram_join.one_of_each(none), suffix_dedup.deduped_documents(none), mixing.mixed_documents(none)):
        assert out.columns == frame.columns and out.isEmpty()
    assert packing.pack(none).isEmpty()


def test_pipeline_against_its_stages(spark, docs, labels, tmp_path):
    """``run`` equals the stages' brute-force versions one after another."""
    d = f"{tmp_path}/data"
    table = [r[:5] for r in docs]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    labels.write.parquet(f"{d}/labels.parquet")
    got = corpus_pipeline.run(spark, d).toPandas()

    docs_ = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.train(docs_, labels)
    m = toxicity.Matcher(model.words, model.stems, model.known)
    now = [r for r in table if model.score(np.array([toxicity.text_features(r[1] or "", m)[0]]))[0] < 0.5]
    assert len(table) - len(now) >= 50
    reach = brute_join(list(dict.fromkeys((r[0], r[1] or "") for r in now if r[0] is not None)), 5, 80, 100)
    now = list(dict.fromkeys(r for r in now if r[0] is not None and reach[r[0]][1] == r[0])) + [r for r in now if r[0] is None]
    keyed = sorted((r for r in now if r[0] is not None), key=lambda r: r[0])
    cut = suffix_dedup.deduped_documents(spark.createDataFrame(now, docs_.schema))
    brute = brute_dedup([(r[0], r[1] or "") for r in keyed], 100)
    texts = {r.doc_id: r.text for r in cut.collect() if r.doc_id is not None}
    no_id = [r.text for r in cut.collect() if r.doc_id is None]
    assert all(hashlib.sha256(t.encode()).hexdigest() == brute[i][1] for i, t in texts.items() if t.isascii())
    now = [(r[0], texts[r[0]], r[2], r[3], len(texts[r[0]])) for r in keyed] + [
        (None, t, "en", None if "three" in t else "s1", len(t)) for t in no_id]
    mixed = [r for r, n in zip(now, mix_copies(now)) for _ in range(n)]
    enc = tokens.ChunkEncoder(tokens.default_vocabulary())
    want = sorted(len(x) // 4 for x in enc.ids([r[1] for r in mixed]))
    assert sorted(got[got.start == 0].doc_tokens) == want
    assert got.length.sum() == sum(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048


def test_remaining_text_without_a_second_worker(spark, docs):
    """The text is decoded where it is put together: no Python step follows another in one task. Cut characters go."""
    same = "".join(chr(0x200 + i) for i in range(60))  # the characters before it differ in their first byte only
    cut = spark.createDataFrame([(1, "\u0141" + same, "en", "s1", 61), (2, "x\u0101" + same, "en", "s1", 62), (3, None, "en", "s1", None)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    out = suffix_dedup.deduped_documents(cut)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    assert out.columns == cut.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {1: ("\u0141" + same, 61), 2: ("x", 1), 3: ("", 0)}


def test_ids_do_not_depend_on_the_slices(monkeypatch):
    texts = [f"Word{i} other, {i * 7} words; " * (i % 9) for i in range(60)]
    enc = tokens.ChunkEncoder(tokens.default_vocabulary())
    whole = enc.ids(texts)
    assert tokens.SLICE_BYTES <= 4 << 20
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    assert enc.ids(texts) == whole


def test_stage_names_and_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]


def test_the_mix_written_as_shards(spark, frame, docs, tmp_path):
    segments = mixing.write_shards(frame, f"{tmp_path}/mix", shards=8, blocks_per_shard=4).toPandas()
    got = spark.read.parquet(f"{tmp_path}/mix").withColumn("file", F.input_file_name()).toPandas()
    assert len(got) == len(segments) and got.n_words.sum() == segments.n_words.sum() and got.shard.nunique() <= 8
    assert (got.groupby("shard").file.nunique() == 1).all()
    texts = {r[0]: (r[1] or "").split() for r in docs if r[0] is not None}
    for r in got[got.doc_id.notna()].head(200).itertuples():
        assert r.text.split(" ") == texts[int(r.doc_id)][r.from_word:r.from_word + r.n_words]
    words = got.groupby("shard").n_words.sum()
    assert words.max() < 2 * words.min()


def test_quotas_are_exact_at_every_node(spark):
    blocks = spark.createDataFrame([("a", 100), ("b", 37), (None, 3), ("c", 0)], "source string, n_blocks long")
    for shards in (1, 2, 16):
        q = mixing.shard_quotas(blocks, shards, 7).toPandas().fillna({"source": "-"})
        assert q.groupby("source").quota.sum().to_dict() == {"a": 100, "b": 37, "-": 3, "c": 0} and (q.quota >= 0).all()
        for level in range(shards.bit_length() - 1):  # nodes of a level differ by rounding only
            total = q.assign(node=q["shard"] // 2 ** level).groupby("node").quota.sum()
            assert total.max() - total.min() <= level + 2 if level else total.max() - total.min() <= shards.bit_length()


def test_the_split_is_a_hypergeometric_draw(spark):
    """Of 40 blocks, 10 of them good, 20 are drawn: the law's mean and variance, over many draws."""
    e = mixing._hypergeometric("40L", "10L", "20L", "u")
    n = 4000
    got = np.array([r.x for r in spark.range(n).selectExpr(f"(id + 0.5D) / {n} as u").selectExpr(f"{e} as x").collect()])
    assert got.min() >= 0 and got.max() <= 10
    assert got.mean() == pytest.approx(5.0, abs=0.02)
    assert got.var() == pytest.approx(20 * 0.25 * 0.75 * 20 / 39, abs=0.03)
    from math import comb
    for k in range(11):
        assert (got == k).mean() == pytest.approx(comb(10, k) * comb(30, 20 - k) / comb(40, 20), abs=0.001)
