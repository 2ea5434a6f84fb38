"""Toxicity: Levenshtein automata intersected with a lexicon trie.

Lexicon.  Labelled training rows (a bounded sample, ``max_rows`` by hash order)
give the document frequency by label of every word and of every word prefix of
3 to 8 letters, and the variety of the words before it (64 hash bins).  A term
enters when its share of toxic documents is at least ``MIN_PRECISION``, its
log-likelihood ratio against the label is at least ``MIN_G2``, and it follows
varied words: words that only recur because a document was copied do not.  A
prefix that no better shorter prefix covers enters as a stem, which
any continuation of letters completes.  Terms are at most ``max_terms``.

Matching.  The lexicon is one trie.  A text's words run through the product of
the trie and a Levenshtein automaton of each term (edits allowed: 1 from 5
letters on, 2 from 9 on; stems are matched without edits).  The product is
determinised lazily: a state is the set of (trie node, edits left) and dies as
soon as no term can be reached, mostly after two or three letters.  Results are
kept per distinct word.  A word near a term that clean training texts use is a
word of its own and no misspelling.

Scoring.  A match counts as quoted if its context window of ``window`` words on
either side holds quotation marks on both sides or a word that reports speech
or talks about words; else as direct.  The features (exact, misspelt and stem
matches, direct and quoted; matches per word; two matches near each other; any
direct match) go through a logistic regression without negative weights: a match
never lowers a score.  It is trained on the same rows and on variants of them: a
toxic text with its terms misspelt stays toxic, a clean text that reports a
quoted term stays clean.  Labels, lang, source and doc_id are never inputs of a score.

Result: a row per document with ``doc_id, held_out, score, predicted, n_terms``
(matches in the text).  Null and empty texts have no matches and get the score
of a text without any.  Rows with a null doc_id are not held out and train
nothing.  Rows that share a doc_id give a row each; a doc_id that has more than
one label row trains with the largest toxic label.  Without labelled rows of
both kinds the lexicon is empty and every score is the toxic share (0.0 if
there are no labels).  Extra columns are ignored."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, shielded, table, worker_table

MAX_ROWS = 20_000
MAX_TERMS = 5_000
MIN_PRECISION = 0.85
MIN_G2 = 18.0
WINDOW = 6
#: A worker starts its automaton anew beyond so many states.
MAX_STATES = 20_000
STEM = (3, 8)
FEATURES = ["exact_direct", "exact_quoted", "fuzzy_direct", "fuzzy_quoted", "stem_direct", "stem_quoted", "density", "near", "any_direct"]
LETTERS = re.compile(r"[^\W\d_]+")

#: Words that report speech or talk about a word.
REPORTING = frozenset("said says say quoted quote quotes wrote writes called word words term phrase slur insult dijo citó escribió palabra "
                      "dit écrit cité mot sagte schrieb zitiert wort".split())
MARKS = frozenset("\"'“”„«»‘’")


class Matcher:
    """Words against the lexicon trie under bounded edits."""

    def __init__(self, words: list[str], stems: list[str], known: frozenset[str] = frozenset()):
        self.words, self.known = words, known
        self.kids: list[dict[str, int]] = [{}]
        self.word_edits: dict[int, int] = {}
        self.is_stem: set[int] = set()
        self.allowed: list[int] = [0]
        for w in words:
            k = 2 if len(w) >= 9 else 1 if len(w) >= 5 else 0
            n = self._add(w, k)
            self.word_edits[n] = k
        for s in stems:
            self.is_stem.add(self._add(s, 0))
        self._forget()
        self.cache: dict[str, int] = {}

    def _forget(self) -> None:
        """Start the determinised product anew."""
        self.states: dict[frozenset, int] = {}
        self.moves: list[dict[str, int]] = []
        self.accept: list[int] = []
        self.sets: list[dict[tuple[int, int], int]] = []
        self.start = self._state(self._closure({(0, 0): 0}))

    def _add(self, w: str, k: int) -> int:
        n = 0
        self.allowed[0] = max(self.allowed[0], k)
        for c in w:
            if c not in self.kids[n]:
                self.kids[n][c] = len(self.kids)
                self.kids.append({})
                self.allowed.append(0)
            n = self.kids[n][c]
            self.allowed[n] = max(self.allowed[n], k)
        return n

    def _closure(self, s: dict) -> dict:
        """Edits that delete a letter of the term: the trie moves, the text stays."""
        todo = list(s)
        while todo:
            n, e = todo.pop()
            for c, m in self.kids[n].items():
                if e + 1 <= self.allowed[m] and (m, e + 1) not in s:
                    s[(m, e + 1)] = 0
                    todo.append((m, e + 1))
        return s

    def _state(self, s: dict) -> int:
        # a node reached with fewer edits covers the same node with more
        least: dict[int, int] = {}
        for n, e in s:
            least[n] = min(e, least.get(n, 9))
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.moves)
            self.moves.append({})
            best = 0
            for n, e in key:
                if n in self.word_edits and e <= self.word_edits[n]:
                    best = max(best, 3 if e == 0 else 1)
            self.accept.append(best)
            self.sets.append(dict.fromkeys(key))
        return self.states[key]

    def _step(self, at: int, c: str) -> int:
        out: dict = {}
        for n, e in self.sets[at]:
            if c in self.kids[n]:
                out[(self.kids[n][c], e)] = 0
            if e < self.allowed[n]:
                out[(n, e + 1)] = 0  # an extra letter
                for d, m in self.kids[n].items():
                    if d != c and e + 1 <= self.allowed[m]:
                        out[(m, e + 1)] = 0  # another letter
        nxt = self._state(self._closure(out)) if out else -1
        self.moves[at][c] = nxt
        return nxt

    def match(self, w: str) -> int:
        """0 no match, 1 misspelt term, 2 stem, 3 exact term."""
        got = self.cache.get(w)
        if got is None:
            got, n = 0, 0
            for c in w:  # stems are exact prefixes
                n = self.kids[n].get(c, -1)
                if n < 0:
                    break
                if n in self.is_stem:
                    got = 2
                    break
            if len(self.moves) > MAX_STATES:
                self._forget()
            at = self.start
            for c in w:
                at2 = self.moves[at].get(c)
                at = self._step(at, c) if at2 is None else at2
                if at < 0:
                    break
            if at >= 0 and (self.accept[at] == 3 or w not in self.known):
                got = max(got, self.accept[at])
            if len(self.cache) >= 300_000:
                self.cache.clear()
            self.cache[w] = got
        return got


def text_features(text: str, m: Matcher, window: int = WINDOW) -> tuple[list[float], int]:
    """Features of one text and its number of matches."""
    low = text.lower()
    words = LETTERS.findall(low)
    cache = m.cache
    hit = {w for w in set(words) if (cache[w] if w in cache else m.match(w))}
    f = [0.0] * len(FEATURES)
    if not hit:
        return f, 0
    spans = [(x.group(), x.start(), x.end()) for x in LETTERS.finditer(low)]
    last, count, near = -10**9, 0, 0
    for i, (w, _, _) in enumerate(spans):
        if w not in hit:
            continue
        a, b = max(0, i - window), min(len(spans) - 1, i + window)
        left, right = low[spans[a][1]:spans[i][1]], low[spans[i][2]:spans[b][2]]
        quoted = (not MARKS.isdisjoint(left) and not MARKS.isdisjoint(right)) or any(spans[j][0] in REPORTING for j in range(a, b + 1))
        kind = {3: 0, 1: 2, 2: 4}[m.match(w)]
        f[kind + quoted] += 1
        near += i - last <= window
        last, count = i, count + 1
    f[:6] = [min(x, 4.0) for x in f[:6]]
    f[6] = min(1.0, 10.0 * count / len(spans))
    f[7] = float(min(near, 3))
    f[8] = float(f[0] + f[4] > 0)
    return f, count


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``text, toxic`` of the training rows, at most ``max_rows`` by hash of the id."""
    lab = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lab = lab.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    lab = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return docs.select("doc_id", "text").join(lab, "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))


def term_counts(train: DataFrame) -> DataFrame:
    """``term, kind, pos, neg, contexts``: labelled documents with the word (kind 0) or the prefix (kind 1),
    and in how many of 64 hash bins the words before it fall."""
    def count(b: pa.RecordBatch) -> list[tuple]:
        c: dict[int, Counter] = {0: Counter(), 1: Counter()}
        seen: dict[tuple[str, int], int] = {}
        for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            ws = LETTERS.findall(text.lower())
            terms = set()
            for before, w in set(zip(["", *ws], ws)):
                bit = 1 << (zlib.crc32(before.encode()) & 63)
                for t in [(w, 0), *((w[:k], 1) for k in range(STEM[0], min(STEM[1], len(w) - 1) + 1))]:
                    terms.add(t)
                    seen[t] = seen.get(t, 0) | bit
            c[int(y > 0)].update(terms)
        return [(t, k, c[1][(t, k)], c[0][(t, k)], m - (1 << 64) if m >> 63 else m) for (t, k), m in seen.items()]

    return map_arrow(train, count, "term string, kind int, pos long, neg long, ctx long").groupBy("term", "kind").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.bit_count(F.bit_or("ctx")).alias("contexts"))


def learn_lexicon(train: DataFrame, n_pos: int, n_neg: int, max_terms: int = MAX_TERMS) -> tuple[list[str], list[str]]:
    """``(words, stems)``; filtered in Spark, so the driver gets ``max_terms`` rows at most."""
    if not n_pos or not n_neg:
        return [], []
    n, p1 = n_pos + n_neg, n_pos / (n_pos + n_neg)

    def part(o, e):
        return F.when(o > 0, o * F.log(o / e)).otherwise(0.0)

    tot = F.col("pos") + F.col("neg")
    g2 = 2 * (part(F.col("pos"), tot * p1) + part(F.col("neg"), tot * (1 - p1))
              + part(n_pos - F.col("pos"), (n - tot) * p1) + part(n_neg - F.col("neg"), (n - tot) * (1 - p1)))
    t = term_counts(train).withColumn("g2", g2).where((F.col("pos") / tot >= MIN_PRECISION) & (F.col("g2") >= MIN_G2)
                                                     & (F.col("contexts") >= F.least(F.lit(20), 0.6 * tot)))
    rows = t.orderBy(F.desc("g2"), "term", "kind").limit(max_terms).collect()
    words = {r.term: r for r in rows if r.kind == 0}
    stems: dict[str, float] = {}
    kept: list[str] = []
    for r in sorted((r for r in rows if r.kind == 1), key=lambda r: (len(r.term), r.term)):
        stems[r.term] = r.g2
    for s in sorted(stems, key=lambda s: (-stems[s], len(s), s)):
        # the strongest prefix of a chain stands for the chain
        if not any(s.startswith(k) or k.startswith(s) for k in kept):
            kept.append(s)
    # a stem that only one word of the lexicon explains is that word, not a stem
    def own(s: str) -> bool:
        inside = [w for w in words if w.startswith(s) and w != s]
        return not any(words[w].g2 >= 0.8 * stems[s] for w in inside)
    kept = [s for s in kept if own(s)]
    return sorted(w for w in words if not any(w.startswith(s) for s in kept)), sorted(kept)


def misspelt(text: str, m: Matcher) -> str:
    """The text with one edit in each exact term that has room for one: a letter
    is left out, doubled or exchanged for its neighbour, as a hash of the word says."""
    def edit(x: re.Match) -> str:
        w = x.group()
        if len(w) < 5 or m.match(w.lower()) != 3:
            return w
        h = zlib.crc32(w.lower().encode())
        i = 1 + h % (len(w) - 2)
        return (w[:i] + w[i + 1:], w[:i] + w[i] + w[i:], w[:i] + ("x" if w[i] != "x" else "z") + w[i + 1:])[h // 7 % 3]
    return LETTERS.sub(edit, text)


def reported(text: str, term: str) -> str:
    """The text with a sentence that quotes ``term``, in its middle."""
    words = text.split(" ")
    half = len(words) // 2
    return " ".join([*words[:half], f'they said "{term}" and left.', *words[half:]])


def variants(text: str, toxic: int, m: Matcher) -> list[tuple[int, str]]:
    """``(label, text)`` of a labelled row and its variant."""
    if toxic > 0:
        other = misspelt(text, m)
        return [(1, text)] + [(1, other)] * (other != text)
    return [(0, text)] + ([(0, reported(text, m.words[zlib.crc32(text.encode("utf-8", "replace")) % len(m.words)]))] if m.words else [])


def fit_positive(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """``fit_logistic`` with weights of at least 0: features whose weight would be
    negative go out, the worst first, until none is left."""
    w, on = np.zeros(x.shape[1]), np.ones(x.shape[1], bool)
    while on.any():
        part, b = fit_logistic(x[:, on], y)
        if (part >= 0).all():
            w[on] = part
            return w, b
        on[np.flatnonzero(on)[part.argmin()]] = False
    return w, fit_logistic(x[:, :0], y)[1]


def half(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace")) & 1


def known_words(train: DataFrame, words: list[str], stems: list[str]) -> list[frozenset[str]]:
    """Words of clean training texts that lie within the edits of a term: words of
    their own, no misspellings.  One set for each ``half`` of the texts.  At most the sample's words near a term."""
    def near(b: pa.RecordBatch) -> list[tuple]:
        m = matcher(words, stems)
        seen = {(w, half(t)) for t in b.column("text").to_pylist() for w in set(LETTERS.findall(t.lower()))}
        return [(w, h) for w, h in seen if m.match(w) == 1]

    got = map_arrow(train.where("toxic = 0"), near, "word string, half int").distinct().collect()
    return [frozenset(r.word for r in got if r.half == h) for h in (0, 1)]


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 60) -> tuple[np.ndarray, float]:
    """Newton steps for a small dense logistic regression; the intercept is not penalised."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    w[-1] = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    reg = np.full(len(w), l2 * len(y))
    reg[-1] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(reg + 1e-9)
        d = np.linalg.solve(h, a.T @ (p - y) + reg * w)
        w -= d * min(1.0, 5.0 / (np.abs(d).max() + 1e-12))
        if np.abs(d).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


class ToxicityModel:
    """Lexicon and weights; small, sent to the tasks with the function that uses it."""

    def __init__(self, words, stems, w, b, known=frozenset()):
        self.words, self.stems, self.w, self.b, self.known = words, stems, np.asarray(w), b, known

    def score(self, feats: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(feats @ self.w + self.b, -30, 30)))


_MATCHERS: dict[tuple, Matcher] = worker_table(__name__)


def matcher(words: list[str], stems: list[str], known: frozenset[str] = frozenset()) -> Matcher:
    """The matchers of a worker process, two at most."""
    key = (tuple(words), tuple(stems), known)
    if key not in _MATCHERS:
        if len(_MATCHERS) > 1:
            _MATCHERS.clear()
        _MATCHERS[key] = Matcher(words, stems, known)
    return _MATCHERS[key]


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> ToxicityModel:
    rows = labelled(docs, labels, max_rows).checkpoint()
    by = {int(r[0] > 0): r[1] for r in rows.groupBy((F.col("toxic") > 0).cast("int").alias("t")).count().collect()}
    n_pos, n_neg = by.get(1, 0), by.get(0, 0)
    if not n_pos or not n_neg:
        share = n_pos / (n_pos + n_neg) if n_pos + n_neg else 0.0
        return ToxicityModel([], [], np.zeros(len(FEATURES)), 30.0 if share > 0 else -30.0)
    words, stems = learn_lexicon(rows, n_pos, n_neg)
    known = known_words(rows, words, stems)

    def feats(b: pa.RecordBatch) -> list[tuple]:
        # a text is read with the words known from the other half, as new texts are
        by = [matcher(words, stems, known[1]), matcher(words, stems, known[0])]
        return [(y, text_features(v, by[half(t)])[0]) for t, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist())
                for y, v in variants(t, label, by[half(t)])]

    got = map_arrow(rows, feats, "y int, f array<double>").groupBy("y", "f").count().collect()  # 2 max_rows short rows at most
    x = np.array([r.f for r in got], dtype=float)
    y = np.array([float(r.y > 0) for r in got])
    n = np.array([r["count"] for r in got])
    w, b = fit_positive(np.repeat(x, n, axis=0), np.repeat(y, n))
    return ToxicityModel(words, stems, w, b, known[0] | known[1])


def score(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None) -> DataFrame:
    """Every row's score.  ``keep``: columns to carry along (default: doc_id)."""
    keep = keep or ["doc_id"]
    d = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce("text", F.lit("")).alias("_t"))
    ddl = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def run(b: pa.RecordBatch) -> list:
        m = matcher(model.words, model.stems, model.known)
        got = [text_features(t, m) for t in b.column("_t").to_pylist()]
        s = model.score(np.array([g[0] for g in got], dtype=float))
        return [*(b.column(f"k{i}") for i in range(len(keep))), s, [g[1] for g in got]]

    out = map_arrow(d, run, f"{ddl}, score double, n_terms long")
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_terms")


def op8(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "n_terms")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pipeline form: documents scored 0.5 or more go; the others keep all their columns."""
    d, back = shielded(docs)
    return back(score(d, train(d, labels), d.columns).where("predicted = 0"))
