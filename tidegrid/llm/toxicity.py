"""Abusive, hateful or sexual language, by the nearest labelled examples.

Documents are read as short passages of words with disguises undone (``passages``). A passage's nearest labelled passages are found exactly by TF-IDF cosine over its words and
pairs of neighbouring words. The examples lie in blocks, and an inverted index holds, for each term, its largest weight in each block: passages whose bound over the blocks
of offending examples is under ``FLOOR`` are done, for nothing offending can vote on them; the rest score their most promising blocks, and every other block that may
still hold one of the k nearest. Distance-weighted votes of the nearest are the passage's score, the worst passage is the document's, calibrated on labelled documents
whose own passages take no part.

Labels are of documents. Which passages of a positive document offend is decided by their words, each a witness by the share of positives among the other documents that
hold it, and then by the votes of their nearest relatives in other documents, copies included, which takes back marks that fell on harmless passages.

Defined results: null, blank and empty texts score 0; a null id is kept with its text's score; rows that repeat give a row each, as in the table; without positive or negative
labels every score is 0. The model is fitted on at most ``MAX_LABELLED`` labelled documents, the first by hash of their id, and is all that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.common import col, require
from tidegrid.llm.passages import Passages, Reader
from tidegrid.llm.wand import BlockMaxIndex, segments

MAX_LABELLED = 4000
#: Neighbours that vote, examples a block, power of the cosine in a vote, weight of the doubt, and the least cosine of a neighbour.
NEIGHBOURS, BLOCK, POWER, PRIOR, FLOOR = 7, 64, 3, 0.08, 0.25
#: Evidence of words at which a passage of a positive and of a negative document offends; documents that a rate is drawn towards the base by; neighbours that judge a mark.
ENOUGH, MOST, DOUBT, RELATIVES = 3.0, 10.0, 3.0, 15
FIRST = 12
#: Passages scored at a time, and scores kept; beyond it all are forgotten and worked out anew, to the same result.
STEP, KEPT = 20_000, 500_000


class Terms:
    """Numbers of the words and pairs of words of passages, as pairs (passage, term) with counts."""

    def __init__(self, words: int):
        self.words = words
        self.keys = np.zeros(0, np.int64)

    def occurrences(self, numbers: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, key) of each known word and each pair of known neighbours."""
        at = np.repeat(np.arange(len(start) - 1), np.diff(start))
        one = numbers > 0
        two = one[:-1] & one[1:] & (at[:-1] == at[1:]) if len(numbers) else one
        return np.r_[at[one], at[:-1][two] if len(numbers) else at], np.r_[numbers[one], numbers[:-1][two] * (self.words + 1) + numbers[1:][two]] if len(numbers) else numbers

    def learn(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)

    def counted(self, numbers: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, term, count) of learnt terms, by passage and term."""
        at, key = self.occurrences(numbers, start)
        if not len(self.keys) or not len(key):
            none = np.zeros(0, np.int64)
            return none, none, none
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        some = self.keys[i] == key
        both = at[some] * len(self.keys) + i[some]
        both.sort()
        new = np.r_[True, both[1:] != both[:-1]] if len(both) else np.zeros(0, bool)
        pos = np.flatnonzero(new)
        return both[pos] // len(self.keys), both[pos] % len(self.keys), np.diff(np.r_[pos, len(both)])


class Examples:
    """Labelled passages and their block-max index. ``numbers`` and ``start``: distinct passages; ``label``: whether they offend."""

    def __init__(self, terms: Terms, numbers: np.ndarray, start: np.ndarray, copies: np.ndarray, label: np.ndarray):
        self.terms = terms
        at, term, count = terms.counted(numbers, start)
        n, width = len(label), len(terms.keys)
        held = np.bincount(term, copies[at] if len(at) else None, width)
        self.idf = np.log((1 + copies.sum()) / (1 + held)) + 1 if width else np.zeros(0)
        weight = count * self.idf[term]
        norm = np.sqrt(np.bincount(at, weight**2, n))
        # offending examples first, and relatives in one block, so that bounds are tight: in the order of the rarest terms of each
        rare = np.full(n, width, np.int64)
        by_idf = np.lexsort((term, -self.idf[term], at))
        first = np.flatnonzero(np.r_[True, np.diff(at[by_idf]) > 0]) if len(at) else np.zeros(0, np.int64)
        rare[at[by_idf][first]] = term[by_idf][first]
        order = np.lexsort((rare, label <= 0.5))
        self.rank = np.empty(n, np.int64)
        self.rank[order] = np.arange(n)
        self.order, self.label, self.offending = order, label[order], int((label > 0.5).sum())
        self.index = BlockMaxIndex(term, self.rank[at], weight / np.maximum(norm[at], 1e-12), width, n, BLOCK)
        #: the offending examples lead every list
        post = self.index.post
        self.bad_post = post[:-1] + np.bincount(np.repeat(np.arange(width), np.diff(post))[self.index.ids < self.offending], minlength=width)
        self.bad_blocks = -(-self.offending // BLOCK)
        self.bad_max = np.zeros((width, self.bad_blocks), np.float32)
        e = np.flatnonzero(self.index.entry_block < self.bad_blocks)
        self.bad_max[np.repeat(np.arange(width), np.diff(self.index.entry))[e], self.index.entry_block[e]] = self.index.entry_max[e]

    def weighted(self, numbers: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(border of each passage, term, weight), the weights of a passage with norm 1."""
        at, term, count = self.terms.counted(numbers, start)
        w = count * self.idf[term]
        w /= np.sqrt(np.bincount(at, w**2, len(start) - 1))[at]
        return np.searchsorted(at, np.arange(len(start))), term, w.astype(np.float32)

    def nearest(self, t: np.ndarray, q: np.ndarray, k: int = NEIGHBOURS, ahead: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples with a cosine of FLOOR or more, exact."""
        return self.index.largest(t, q, k, FLOOR, FIRST, ahead) if len(t) else (np.zeros(0, np.int64), np.zeros(0))

    def suspects(self, border: np.ndarray, term: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passages that have an offending example with a cosine of FLOOR or more, and the largest such cosine; only those whose bound over some block of such examples allows it are scored against them."""
        some = np.flatnonzero(np.diff(border))
        if not self.bad_blocks or not len(some):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = np.add.reduceat(self.bad_max[term] * w[:, None], border[some], axis=0)
        some = some[bound.max(axis=1) * (1 + 1e-5) >= FLOOR]
        post, most = self.index.post, np.zeros(len(some))
        for k in range(0, len(some), 2000):
            part = some[k : k + 2000]
            pos, edge = segments(border, part)
            t = term[pos]
            size = self.bad_post[t] - post[t]
            at = np.repeat(post[t] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            cell = np.repeat(np.repeat(np.arange(len(part)), np.diff(edge)), size) * self.offending + self.index.ids[at]
            cosine = np.bincount(cell, self.index.weights[at] * np.repeat(w[pos], size), len(part) * self.offending)
            most[k : k + 2000] = cosine.reshape(len(part), -1).max(axis=1)
        return some[most >= FLOOR], most[most >= FLOOR]

    def score(self, numbers: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Distance-weighted votes of the nearest examples of each passage."""
        out = np.zeros(len(start) - 1)
        border, term, w = self.weighted(numbers, start)
        for p, most in zip(*map(np.ndarray.tolist, self.suspects(border, term, w))):  # none that has NEIGHBOURS harmless examples nearer than any offending one
            i, s = self.nearest(term[border[p] : border[p + 1]], w[border[p] : border[p + 1]], NEIGHBOURS, most * (1 + 1e-5))
            v = s**POWER
            out[p] = (v * self.label[i]).sum() / (v.sum() + PRIOR)
        return out


def log_odds(bad: np.ndarray, every: np.ndarray, base: float) -> np.ndarray:
    r = (bad + DOUBT * base) / (every + DOUBT)
    return np.log(r / (1 - r)) - np.log(base / (1 - base))


class Model:
    """The examples of all labelled documents and the score at which a document counts as offending."""

    def __init__(self, docs: Sequence[tuple[str | None, int]]):
        y = np.array([int(v) for _, v in docs], np.int64)
        texts = [t for t, _ in docs]
        self.usable, self.cut = len(set(y.tolist())) == 2, 0.5
        every = Reader()
        p = every.batch(texts)
        both = np.unique(np.repeat(p.text, np.diff(p.start)) * (len(every.number) + 1) + p.numbers)
        doc, word = both // (len(every.number) + 1), both % (len(every.number) + 1)
        seen = np.bincount(word, minlength=len(every.number) + 1)
        seen_bad = np.bincount(word[y[doc] > 0], minlength=len(every.number) + 1) if len(doc) else seen
        self.reader = Reader(w for w, i in every.number.items() if seen[i] >= 3 or (seen[i] >= 2 and seen_bad[i]))
        self.memo: dict[bytes, float] = {}
        p = self.reader.batch(texts)
        kinds: dict[bytes, int] = {}
        of = np.fromiter((kinds.setdefault(b, len(kinds)) for b in keys_of(p)), np.int64, len(p))
        first = np.full(len(kinds), len(p), np.int64)
        np.minimum.at(first, of, np.arange(len(p)))
        at, start = segments(p.start, first)
        numbers = p.numbers[at]
        terms = Terms(len(self.reader.number))
        terms.learn(terms.occurrences(numbers, start)[1])
        copies = np.bincount(of, minlength=len(kinds)).astype(float)
        if not self.usable:
            self.examples = Examples(terms, numbers[:0], np.zeros(1, np.int64), copies[:0], copies[:0])
            return
        mark = self.witnessed(p, y)
        for kind in ("documents", "marks"):
            mark = self.settled(p, of, first, y[p.text].astype(float) if kind == "documents" else mark.astype(float), mark, Examples(terms, numbers, start, copies, np.zeros(len(kinds))), numbers, start)
        label = lambda use: np.bincount(of[use], mark[use], len(kinds)) / np.maximum(np.bincount(of[use], minlength=len(kinds)), 1)
        # held-out scores: each half of the documents against the passages of the other
        half, score = p.text % 2, np.zeros(len(docs))
        for h in (0, 1):
            mine = np.flatnonzero(np.bincount(of[half != h], minlength=len(kinds)))
            a, s = segments(start, mine)
            ex = Examples(terms, numbers[a], s, np.bincount(of[half != h], minlength=len(kinds))[mine].astype(float), label(half != h)[mine])
            asked = np.unique(of[half == h])
            got = np.zeros(len(kinds))
            a, s = segments(start, asked)
            got[asked] = ex.score(numbers[a], s)
            np.maximum.at(score, p.text[half == h], got[of[half == h]])
        self.examples = Examples(terms, numbers, start, copies, label(np.ones(len(p), bool)))
        grid = np.arange(0.2, 0.9, 0.02)
        f1 = [2 * (y[score >= c]).sum() / max((score >= c).sum() + y.sum(), 1) for c in grid]
        # the middle of the best stretch: neither labels nor halves are exact
        self.cut, self.f1 = float(np.median(grid[np.array(f1) >= max(f1) - 0.01])), float(max(f1))
        # calibration: share of positives by score, monotone
        order = np.argsort(score, kind="stable")
        merged: list[list[float]] = []
        for b in ([float(s), float(v), 1.0] for s, v in zip(score[order], y[order])):
            merged.append(b)
            while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
                b = merged.pop()
                merged[-1] = [b[0], merged[-1][1] + b[1], merged[-1][2] + b[2]]
        self.steps = np.array([b[0] for b in merged]), np.array([(b[1] + 0.5) / (b[2] + 1) for b in merged])

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    def witnessed(self, p: Passages, y: np.ndarray) -> np.ndarray:
        """Passages with ENOUGH evidence of their words in a positive document, MOST in a negative one."""
        width = len(self.reader.number) + 1
        pair = np.unique(np.repeat(p.text, np.diff(p.start)) * width + p.numbers)
        every, bad = np.bincount(pair % width, minlength=width), np.bincount((pair % width)[y[pair // width] > 0], minlength=width)
        own = np.unique(np.repeat(np.arange(len(p)), np.diff(p.start)) * width + p.numbers)
        at, word = own // width, own % width
        of = y[p.text[at]]
        base = min(max(y.mean(), 0.01), 0.5)
        seen = np.bincount(at, np.where(word > 0, np.maximum(-1.0, log_odds(bad[word] - of, every[word] - 1, base)), 0.0), len(p))
        return seen >= np.where(y[p.text] > 0, ENOUGH, MOST)

    def settled(self, p: Passages, of: np.ndarray, first: np.ndarray, value: np.ndarray, mark: np.ndarray, examples: Examples, numbers: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Marks that near relatives contradict are taken back. ``value``: what a relative's passages say, that is their document's label, or the marks that are left."""
        n, k = np.bincount(of, minlength=len(first)).astype(float), np.bincount(of, value, len(first))
        marked = np.unique(of[mark])
        a, s = segments(start, marked)
        border, term, w = examples.weighted(numbers[a], s)
        inside, outside = {}, {}
        for j, c in enumerate(marked.tolist()):
            i, sim = examples.nearest(term[border[j] : border[j + 1]], w[border[j] : border[j + 1]], RELATIVES)
            kin = examples.order[i]
            v = np.where(kin == c, 0.0, sim**POWER)
            inside[c], outside[c] = float((v * k[kin]).sum()), float((v * n[kin]).sum())
        out = mark.copy()
        for q in np.flatnonzero(mark).tolist():
            c = int(of[q])
            some, whole = inside[c] + k[c] - value[q], outside[c] + n[c] - 1
            out[q] = not (whole >= DOUBT / 2 and some < 0.5 * whole)
        return out

    def calibrated(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, *self.steps) if self.usable else np.zeros(len(score))

    def scored(self, texts: Sequence[str | None]) -> tuple[np.ndarray, list[str | None]]:
        """The raw score of the worst passage of each text, and that passage where the text offends."""
        raw, worst = np.zeros(len(texts)), [None] * len(texts)
        if not self.usable:
            return raw, worst
        p = self.reader.batch(texts)
        if len(self.memo) > KEPT:
            self.memo.clear()
        new: dict[bytes, int] = {}
        keys = keys_of(p)
        for i, b in enumerate(keys):
            if b not in self.memo:
                new.setdefault(b, i)
        at = np.fromiter(new.values(), np.int64, len(new))
        for k in range(0, len(at), STEP):
            pos, start = segments(p.start, at[k : k + STEP])
            for i, s in zip(at[k : k + STEP].tolist(), self.examples.score(p.numbers[pos], start).tolist()):
                self.memo[keys[i]] = s
        got = np.fromiter(map(self.memo.__getitem__, keys), float, len(keys))
        np.maximum.at(raw, p.text, got)
        for i in np.flatnonzero(got >= self.cut)[::-1].tolist():
            if got[i] == raw[p.text[i]]:
                worst[p.text[i]] = p.written(i)
        return raw, worst


def keys_of(p: Passages) -> list[bytes]:
    whole, b = p.numbers.astype(np.int32).tobytes(), (p.start * 4).tolist()
    return [whole[x:y] for x, y in zip(b, b[1:])]


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> list[tuple[str, int]]:
    """At most MAX_LABELLED labelled documents, by hash of the id; a document labelled twice takes the larger label."""
    marks = labels.where(col(key).isNotNull() & col(label).isNotNull()).groupBy(col(key).alias("k")).agg(F.max(col(label).cast("int")).alias("y"))
    marks = marks.orderBy(F.xxhash64("k"), "k").limit(MAX_LABELLED)
    rows = docs.where(col(text).isNotNull()).select(col(key).alias("k"), col(text).alias("t")).join(F.broadcast(marks), "k").orderBy(F.xxhash64("k"), "k", "t").limit(MAX_LABELLED).collect()
    return [(r["t"], int(r["y"] > 0)) for r in rows]


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", keep: Sequence[str] = ()) -> DataFrame:
    """(key, *keep, score, is_offending, evidence): every row of ``docs``; evidence is the worst passage of an offending text. One Arrow pass, no shuffle."""
    require(docs, key, text, *keep)
    require(labels, key, label)
    shared = docs.sparkSession.sparkContext.broadcast(Model(labelled_sample(docs, labels, key, text, label)))
    names = [key, *keep]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("score", T.DoubleType()), T.StructField("is_offending", T.BooleanType()), T.StructField("evidence", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            raw, worst = m.scored(b.column(b.num_columns - 1).to_pylist())
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            bad = pa.array(m.usable & (raw >= m.cut), pa.bool_())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(m.calibrated(raw), pa.float64()), bad, pa.array(worst, pa.string())], names=[*names, "score", "is_offending", "evidence"])

    return docs.select(*[col(c) for c in names], col(text).alias("_text")).mapInArrow(run, schema)
