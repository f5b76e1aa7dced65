"""Toxicity: a lexicon trie met by Levenshtein automata, scored in context.

Lexicon. Terms are learned from labelled documents: words, and stems (word
beginnings), that occur in several different toxic documents and in next to no
clean ones. A caller may give terms of their own instead.

Matching. The terms form a trie. A Levenshtein automaton runs along it: a state
is the set of (trie node, edits so far) reachable on the characters read. States
and transitions are determinised as words ask for them, so a word costs one
dictionary step per character and most words die after a few. Short terms match
exactly, longer ones with one edit, of which look-alike characters (0/o, 1/i,
3/e, 4/a, 5/s, @/a, $/s) cost none. Words seen in clean training documents are
never taken as misspellings.

Scoring. Each hit has a context window of words before and after it: quotation
marks around the hit and words of report lower its weight, direct address and
further hits in the window raise it. The document's features (weighted hits,
the strongest window, hits per word, exact and misspelled hits) go through a
logistic model fitted to the training rows.

Training reads at most about ``TRAIN_ROWS`` labelled rows, chosen by a hash of
the id (toxic and clean rows each up to half); of near copies (equal least
hash of their word triples) one row is used, so one document copied a thousand
times does not become the lexicon. Every document is scored, whole.

Defined cases: NULL and empty texts score as texts without hits; rows without a
doc_id are scored, never trained on; several labels for one id: the largest;
labels without a document, or NULL, are ignored; without toxic training rows every score is the
share of toxic training rows (0 if there are none); repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiary.session import small_batches

#: Bound on the labelled rows that are read to fit (half of them per label).
TRAIN_ROWS = 24_000
#: A term occurs in so many different toxic training documents at least, and in this share of
#: them. So the lexicon, which every task holds, has at most 1 / LEAST_SHARE = 250 times as many terms as a
#: toxic training document has different words and stems on average; all that qualify are kept.
LEAST_TOXIC, LEAST_SHARE = 4, 0.004
WINDOW = 8
#: Words from this length on may be misspelled by one edit.
FUZZY_FROM = 5
STEM = (4, 5, 6)

_TOKEN = re.compile(r"[\w@$]+")
_ALIKE = str.maketrans("013457@$", "oieastas")
_REPORT = frozenset("said says quote quoted quotes word term called wrote writes phrase".split())
_ADDRESS = frozenset("you your youre yourself u ur".split())
_QUOTES = "\"'“”„‘’«»`"


class Lexicon:
    """The lazily determinised product of term trie and Levenshtein automaton."""

    def __init__(self, terms: list[str], clean: list[str] = ()):
        self.next, self.final, self.depth_left = [{}], [0], [0]  # final: 1 word, 2 stem
        for term in terms:
            stem, word, node = term.endswith("*"), term.rstrip("*"), 0
            for c in word:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.final.append(0)
                    self.depth_left.append(0)
                node = self.next[node][c]
            self.final[node] |= 2 if stem else 1
            if len(word) >= FUZZY_FROM and not stem:
                self._allow(word)
        self.clean = frozenset(clean)
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.step: list[dict] = []
        self.accept: list[int] = []
        self.start = self._state(self._closed({(0, 0)}))
        self.dead = self._state(frozenset())
        self.memo: dict[str, int] = {}

    def _allow(self, word: str) -> None:
        """Marks the nodes on the way of a word that may be misspelled."""
        node = 0
        self.depth_left[0] = 1
        for c in word:
            node = self.next[node][c]
            self.depth_left[node] = 1

    def _closed(self, states: set) -> frozenset:
        """Adds what dropping one character of the term reaches."""
        out = set(states)
        for node, edits in states:
            if edits == 0:
                out |= {(n, 1) for n in self.next[node].values() if self.depth_left[n]}
        return frozenset((n, e) for n, e in out if not (e and (n, 0) in out))

    def _state(self, states: frozenset) -> int:
        at = self.ids.get(states)
        if at is None:
            at = self.ids[states] = len(self.sets)
            self.sets.append(states)
            self.step.append({})
            exact = any(e == 0 and self.final[n] & 1 for n, e in states)
            near = any(e == 1 and self.final[n] & 1 and self.depth_left[n] for n, e in states)
            self.accept.append(3 if exact else 1 if near else 0)
        return at

    def _move(self, at: int, c: str) -> int:
        alike = c.translate(_ALIKE)
        out = set()
        for node, edits in self.sets[at]:
            for x in {c, alike}:
                if x in self.next[node]:
                    out.add((self.next[node][x], edits))
            if edits == 0 and self.depth_left[node]:
                out.add((node, 1))  # an extra character
                out |= {(n, 1) for n in self.next[node].values() if self.depth_left[n]}  # another character
        to = self._state(self._closed(out))
        self.step[at][c] = to
        return to

    def match(self, word: str) -> int:
        """3: a term; 2: begins with a stem; 1: a misspelled term; 0: none."""
        known = self.memo.get(word)
        if known is not None:
            return known
        at, stem = self.start, False
        for c in word:
            to = self.step[at].get(c)
            at = self._move(at, c) if to is None else to
            if at == self.dead:
                break
            stem = stem or any(e == 0 and self.final[n] & 2 for n, e in self.sets[at])
        kind = 2 if stem else 0
        if at != self.dead:
            kind = max(kind, self.accept[at])
        if kind == 1 and word in self.clean:
            kind = 0
        if len(self.memo) > 1 << 19:
            self.memo.clear()
        self.memo[word] = kind
        return kind


def words_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The document's features; a fixed number of floats."""
    words = words_of(text)
    match, memo = lexicon.match, lexicon.memo.get
    for w in set(words):
        if memo(w) is None:
            match(w)
    kinds = [memo(w) for w in words]
    if None in kinds:  # the cache was emptied on the way
        kinds = [match(w) for w in words]
    hits = [i for i, k in enumerate(kinds) if k]
    if not hits:
        return [0.0] * 6
    quoted = set()
    if any(q in text for q in _QUOTES):
        spans = [m.span() for m in _TOKEN.finditer(text.lower())]
        lower = text.lower()
        for i in hits:
            a, b = spans[i]
            if a and b < len(lower) and lower[a - 1] in _QUOTES and lower[b] in _QUOTES:
                quoted.add(i)
    total, strongest, j, k = 0.0, 0.0, 0, 0
    for i in hits:
        while hits[j] < i - WINDOW:
            j += 1
        while k < len(hits) and hits[k] <= i + WINDOW:
            k += 1
        around = words[max(0, i - WINDOW):i + WINDOW + 1]
        weight = 1.0 if kinds[i] == 3 else 0.8
        if i in quoted:
            weight *= 0.4
        if not _REPORT.isdisjoint(around):
            weight *= 0.5
        if not _ADDRESS.isdisjoint(around):
            weight *= 1.5
        window = weight * (1 + 0.25 * (k - j - 1))
        total += weight
        strongest = max(strongest, window)
    exact = sum(kinds[i] == 3 for i in hits)
    return [math.log1p(total), min(strongest, 4.0), min(1.0, total / len(words) * 20), math.log1p(exact),
            math.log1p(len(hits) - exact), 1.0]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the rows that may be learned from."""
    truth = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")) \
                  .filter("toxic is not null and id is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    learn = F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0
    return docs.select("doc_id", "text").join(truth.filter(learn), F.col("doc_id") == F.col("id")).drop("id")


def _train_ids(labels: DataFrame, rows: int) -> DataFrame:
    """Training labels cut to about ``rows`` by a hash of the id, half per label."""
    truth = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id") \
                  .agg(F.max(F.col("toxic").cast("int")).alias("toxic")) \
                  .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    n = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for label, k in n.items():
        share = F.when(F.col("toxic") == label, min(1.0, rows / 2 / k)).otherwise(share)
    return truth.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))


def train_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): at most about ``rows`` labelled documents, one per near copy."""
    # bounded by ``rows``: safe to broadcast
    ids = _train_ids(labels, rows).select(F.col("doc_id").alias("id"), "toxic")
    found = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("doc_id", "text", "toxic")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from topiary.llm.textbytes import NON_SPACE, Words, blocks, shingles
        for batch in batches:
            marks = []
            for _, _, data, offsets in blocks(batch.column(1)):
                w = Words(data, offsets, NON_SPACE)
                runs = shingles(w.hash, 3)
                for r in range(len(offsets) - 1):
                    a, b = int(w.first[r]), int(w.first[r + 1])
                    marks.append(int(runs[a:b - 2].min()) if b - a >= 3 else int(w.hash[a:b].sum(dtype=np.uint64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(marks, dtype=np.uint64).view(np.int64))],
                                             ["doc_id", "text", "toxic", "mark"])

    marked = found.mapInArrow(mark, "doc_id long, text string, toxic int, mark long")
    return marked.groupBy("mark", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("row")).select("row.text", "toxic")


def learn_terms(train: DataFrame, totals: dict[int, int]) -> tuple[list[str], list[str]]:
    """(terms, clean words): terms by their documents' labels; words of clean
    documents that one edit would turn into a term."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter
        n = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in words_of(text or "") if not w.isdigit()}
                stems = {w[:k] + "*" for w in words for k in STEM if len(w) > k}
                for w in words | stems:
                    if len(w) > 2:
                        n[w, toxic] += 1
        for k in range(0, len(items := list(n.items())), 50_000):
            part = items[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for (w, _), _ in part]), pa.array([t for (_, t), _ in part], pa.int32()),
                                              pa.array([c for _, c in part], pa.int64())], ["word", "toxic", "n"])

    seen = train.mapInArrow(counts, "word string, toxic int, n long").groupBy("word").agg(
        F.sum(F.when(F.col("toxic") > 0, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") > 0, 0).otherwise(F.col("n"))).alias("clean"))
    seen = seen.persist()
    bad, good = max(1, totals.get(1, 0)), max(1, totals.get(0, 0))
    # far likelier in toxic documents, and next to absent from clean ones
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("clean") + 0.5) / (good + 1.0))
    weight = odds * F.sqrt(F.col("toxic"))
    picked = (seen.filter((F.col("toxic") >= max(LEAST_TOXIC, LEAST_SHARE * bad)) & (odds > 3.0) & (F.col("clean") * 20 * bad <= F.col("toxic") * good))
              .select("word", weight.alias("w")).orderBy(F.desc("w"), "word").collect())
    terms = [r["word"] for r in picked]
    matcher = [t for t in terms if not t.endswith("*") and len(t) >= FUZZY_FROM]
    clean: list[str] = []
    if matcher:
        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon = Lexicon(matcher)
            for batch in batches:
                yield batch.filter(pa.array([lexicon.match(w) == 1 for w in batch.column(0).to_pylist()], pa.bool_()))

        # all of them, or clean documents would have hits; no more than the training sample's words near a term
        words = seen.filter((F.col("clean") >= 1) & ~F.col("word").endswith("*")).select("word")
        clean = [r["word"] for r in words.mapInArrow(near, "word string").orderBy("word").collect()]
    seen.unpersist()
    return terms, clean


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method; the first coefficient is the intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, g)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, terms: list[str], clean: list[str], weights: np.ndarray | None, prior: float):
        self.terms, self.clean, self.weights, self.prior = terms, clean, weights, prior

    def scorer(self):
        lexicon = Lexicon(self.terms, self.clean)

        def score(text: str) -> float:
            if self.weights is None:
                return self.prior
            z = self.weights[0] + float(np.dot(self.weights[1:], features(text, lexicon)))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    from topiary.llm.common import frozen
    small_batches(docs.sparkSession)
    train = frozen(train_rows(docs, labels, rows))
    totals = {r["t"]: r["n"] for r in train.groupBy((F.col("toxic") > 0).cast("int").alias("t")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(totals.values())
    if not totals.get(1) or not totals.get(0):
        return Model([], [], None, totals.get(1, 0) / n if n else 0.0)
    terms, clean = learn_terms(train, totals)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(terms, clean)
        for batch in batches:
            x = [features(t or "", lexicon) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    got = train.mapInArrow(seen, "x array<double>, toxic int").collect()  # ``rows`` rows of six numbers at most
    x, y = np.array([r["x"] for r in got]), np.array([float(r["toxic"] > 0) for r in got])
    return Model(terms, clean, fit_logistic(x, y), float(y.mean()))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (needs ``text``), or only its columns ``keep``, with ``toxicity``."""
    small_batches(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("toxicity", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value.scorer()
        for batch in batches:
            found = pa.array([one(t or "") for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), found], [*keep, "toxicity"])

    return docs.mapInArrow(scored, schema)
