"""Evaluation texts inside training documents: BM25 block-max retrieval of test items by every passage, then exact alignment.

Documents are cut into overlapping passages of ``PASSAGE`` words. Each queries the index of test items with its words that stand beside a word which they also stand beside in
some item; an item's threshold is the lowest score that any admissible piece of it can have then (``PIECE`` words, two of them changed and two more alone between a change and an
end). Words that were run together or torn apart are looked up as what they are put together or taken apart.
A retrieved (document, item) is then aligned over the whole document as one stream of letters, so that spacing does not matter at all.

Words are what blanks separate, without anything but letters and digits; a test item's lone marks (a dash between blanks) keep their place among its words, as empty ones: they count
as words, a document may lack them, and another word may stand in their place as in that of any word. Defined results: a null id or text matches nothing; blank and too short texts hold no passage; several
rows of one id are one case; copies of an item are all reported; the test items must fit ``MAX_ITEMS`` rows and ``MAX_ITEM_WORDS`` words, which is checked; their index is
built once and is the only thing broadcast.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.common import bounded_rows, col, require
from tidegrid.llm.canonical import joined, unmarked
from tidegrid.llm.wand import BlockMaxIndex

#: Words: of a passage, from one passage to the next, of the least admissible piece and of the whole leak; fewest words from one changed word to the next.
PASSAGE, STRIDE, PIECE, LEAK, APART = 48, 16, 16, 24, 8
#: Words in a row that are unchanged in any admissible piece: between two changes, or beside the only one.
SURE = 7
#: Pieces that one word may be torn into, or words run together, and still be retrieved by itself; alignment has no such limit.
TORN = 3
MAX_ITEMS, MAX_ITEM_WORDS = 200_000, 20_000_000
#: Words kept with what they are; beyond it all are forgotten and worked out anew, to the same result.
KEPT = 400_000
BLOCK, K1, B = 32, 1.2, 0.4


def split(text: str | None) -> list[str]:
    """The words of a text, canonical; lone marks are empty words."""
    return list(map(joined, unmarked(text).split())) if text else []


class Item:
    """A test item, ready for alignment: by the first three letters, where two of its words may begin a run; and its pairs of neighbouring terms."""

    def __init__(self, words: Sequence[str], term: dict[str, int] | None = None):
        self.words = words
        t = [term[w] for w in words if w] if term else []
        self.pairs = {a * len(term or ()) + b for a, b in zip(t, t[1:])}
        self.begin: dict[str, list[tuple[int, str]]] = {}
        some = [j for j, w in enumerate(words) if w]
        for k in (1, 2):
            for j, x in zip(some, some[k:]):
                both = words[j] + words[x]
                self.begin.setdefault(both[:3], []).append((j, both))


class Items:
    """The test items, their BM25 index and thresholds."""

    def __init__(self, texts: Sequence[Sequence[str]]):
        self.texts, self.ready = texts, {}
        length = np.array([len(x) for x in texts], np.int64)
        self.term: dict[str, int] = {}
        every = np.fromiter((self.term.setdefault(w, len(self.term)) if w else -1 for x in texts for w in x), np.int64, int(length.sum()))
        where = np.repeat(np.arange(len(texts)), length)
        some = every >= 0
        flat, item = every[some], where[some]
        length = np.bincount(item, minlength=len(texts))
        width = len(self.term)
        pair, count = np.unique(item * max(width, 1) + flat, return_counts=True)
        of, t = pair // max(width, 1), pair % max(width, 1)
        held = np.bincount(t, minlength=width)
        idf = np.log(1 + (len(texts) - held + 0.5) / (held + 0.5))
        weight = idf[t] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[of] / max(length.mean(), 1.0))) if len(pair) else idf[:0]
        self.index = BlockMaxIndex(t, of, weight, width, len(texts), BLOCK)
        own = np.zeros(len(every))
        own[some] = weight.astype(np.float32)[np.searchsorted(pair, item * max(width, 1) + flat)]
        self.least = self.thresholds(every, where, own, len(texts))
        # lone marks prove nothing: the most of them in a row of SURE words, and in a piece
        marks = np.r_[0, np.cumsum(~some)]
        most = lambda n: int((marks[n:] - marks[:-n]).max(initial=0))
        self.sure, self.paired = SURE - most(SURE), PIECE - 5 - most(PIECE)
        self.block_least = self.index.least_by_block(self.least)
        self.lowest = float(self.least.min(initial=np.inf))
        self.pairs = np.unique(flat[:-1][item[:-1] == item[1:]] * width + flat[1:][item[:-1] == item[1:]]) if len(flat) else flat
        self.heads = {w[:k] for w in self.term for k in range(1, len(w))}
        self.tails = {w[k:] for w in self.term for k in range(1, len(w))}
        self.longest = max(map(len, self.term), default=0)

    def aligned(self, j: int) -> Item:
        if j not in self.ready:
            if len(self.ready) > 10_000:
                self.ready.clear()
            self.ready[j] = Item(self.texts[j], self.term)
        return self.ready[j]

    @staticmethod
    def thresholds(flat: np.ndarray, item: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        """By item, the lowest score of an admissible piece of it: over its windows of PIECE words, without the two changed words, APART or more from each
        other, that take most with them; a word alone between a change and an end goes with it. A word that repeats in a window counts once."""
        out = np.full(n, np.inf)
        if len(flat) < PIECE:
            return out
        by = np.lexsort((np.arange(len(flat)), flat, item))
        before = np.full(len(flat), -1, np.int64)
        same = (flat[by][1:] == flat[by][:-1]) & (item[by][1:] == item[by][:-1])
        before[by[1:][same]] = by[:-1][same]
        view = np.lib.stride_tricks.sliding_window_view
        at = np.flatnonzero(item[PIECE - 1 :] == item[: len(item) - PIECE + 1])
        for k in range(0, len(at), 100_000):
            a = at[k : k + 100_000]
            w = np.where(view(before, PIECE)[a] >= a[:, None], 0.0, view(own, PIECE)[a])
            lost = w.copy()
            mark = view(flat, PIECE)[a] < 0
            lost[:, 1] += w[:, 0]
            lost[:, 2] += np.where(mark[:, 1], w[:, 0], 0)
            lost[:, -2] += w[:, -1]
            lost[:, -3] += np.where(mark[:, -2], w[:, -1], 0)
            most = np.maximum.accumulate(lost, axis=1)
            np.minimum.at(out, item[a], w.sum(axis=1) - np.maximum((most[:, :-APART] + lost[:, APART:]).max(axis=1), most[:, -1]))
        return out * (1 - 1e-5)


class Reader(dict):
    """By written word, its number: ``word`` has the canonical word of each number, ``term`` the item term of it or -1, ``apart`` the terms that it is made of when it is none,
    ``part`` whether it may begin (1) or end (2) a term."""

    def __init__(self, items: Items):
        super().__init__()
        self.items = items
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.word: list[str] = []
        self.term = array("i")
        self.part = array("b")
        self.apart: dict[int, list[int]] = {}

    def __missing__(self, raw: str) -> int:
        w, get = joined(raw), self.items.term.get
        n = self[raw] = len(self.word)
        self.word.append(w)
        self.term.append(get(w, -1) if w else -1)
        self.part.append((w in self.items.heads) + 2 * (w in self.items.tails))
        if self.term[n] < 0 and len(w) > 2:
            cut = self._cut(w, TORN)
            if cut:
                self.apart[n] = sorted({get(x) for x in cut})
        return n

    def _cut(self, w: str, most: int) -> list[str]:
        """The word as up to ``most`` known words, the first longest."""
        known = self.items.term
        for k in range(min(len(w), self.items.longest), 0, -1):
            if w[:k] in known:
                if k == len(w):
                    return [w]
                if most > 1 and (rest := self._cut(w[k:], most - 1)):
                    return [w[:k], *rest]
        return []


class Stream:
    """A document as one stream of letters; ``edge`` are the positions at which its words begin, and its end."""

    def __init__(self, words: Sequence[str]):
        self.letters = "".join(words)
        self.edge = list(accumulate(map(len, words), initial=0))
        self.following = dict(zip(self.edge, self.edge[1:]))
        self.preceding = dict(zip(self.edge[1:], self.edge))
        self.head = [self.letters[p : p + 3] for p in self.edge]


def runs(doc: Stream, test: Item) -> list[tuple[int, int, int, int, int, int]]:
    """(first item word, last, where it begins in the stream, where it ends, how many more item words precede it if one changed word does, and follow it) of the maximal runs of
    item words in which single words are missing or replaced, no two of them less than APART apart."""
    s, edge, following, preceding, begin = doc.letters, doc.edge, doc.following, doc.preceding, test.begin
    item, n = test.words, len(test.words)
    # (position, last item word) -> (first item word, last changed one, begin in the stream, first changed one)
    state: dict[int, dict[int, tuple[int, int, int, int]]] = {}

    def changed(t: tuple[int, int, int, int], j: int) -> tuple[int, int, int, int]:
        """The run, with word j missing or replaced; too near to the change before, it begins anew after that one."""
        a, c, d, f = t
        return (a, j, d, min(f, j)) if j - c >= APART else (c + 1, j, d + sum(map(len, item[a : c + 1])), j)

    def reach(at: int, j: int, t: tuple[int, int, int, int]) -> None:
        if j < n and s.startswith(item[j], at):  # a lone mark takes no letters
            there = state.setdefault(at + len(item[j]), {})
            if j not in there or t < there[j]:
                there[j] = t

    done = []
    k, ahead = 0, len(s) + 1
    while True:
        while k < len(edge) and edge[k] < ahead:  # words at which a run may begin: two item words follow
            p = edge[k]
            for j, both in begin.get(doc.head[k], ()):
                if s.startswith(both, p):
                    reach(p, j, (j, -APART, p, n + APART))
                    ahead = min(ahead, p + len(item[j]))
            k += 1
        if not state:
            break
        position = min(state)
        for j, t in state.pop(position).items():
            a, c, d, f = t
            if item[j] and j - a + 1 >= PIECE - 2:
                done.append((a, j, d, position, f, c))
            reach(position, j + 1, t)
            new = changed(t, j + 1)
            reach(position, j + 2, new)
            if position in following:
                reach(following[position], j + 2, new)
        ahead = min(state, default=len(s) + 1)
    last: dict[tuple[int, int], tuple] = {}
    for r in done:
        if (r[0], r[2]) not in last or r[1] > last[r[0], r[2]][1]:
            last[r[0], r[2]] = r
    out = []
    for a, b, d, end, f, c in last.values():
        left, right = int(a > 0 and f - (a - 1) >= APART), int(b + 1 < n and b + 1 - c >= APART)
        if left and a > 1 and item[a - 2] and (s.endswith(item[a - 2], 0, d) or s.endswith(item[a - 2], 0, preceding.get(d, 0))):
            left = 2
        if right and b + 2 < n and item[b + 2] and (s.startswith(item[b + 2], end) or s.startswith(item[b + 2], following.get(end, len(s)))):
            right = 2
        out.append((a, b, d, end, left, right))
    return out


def leaked(doc: Stream, item: Item) -> int:
    """Item words of the longest leak: one run of LEAK words, or two of PIECE that continue each other across other text; a changed word at either end counts. 0 if there is none."""
    got = runs(doc, item)
    best = 0
    for a, b, _, end, left, right in got:
        whole = b - a + 1 + left + right
        best = max(best, whole if whole >= LEAK else 0)
        for c, d, begin, _, _, later in got:
            between = sum(map(bool, item.words[b + 1 : c]))
            if begin < end or c <= a or d <= b or between > 1:
                continue
            c = max(c, b + 1)  # the second may repeat some of the first's last words by chance
            if b - a + 1 + left + between >= PIECE and d - c + 1 + later + between >= PIECE and d - a + 1 + left + later >= LEAK:
                best = max(best, d - a + 1 + left + later)
    return best


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_key, n_words, score): each document that holds an admissible passage of an item, the words of the longest and the best BM25 score of its
    passages. One Arrow pass over the documents; only cases are shuffled."""
    require(docs, key, text)
    require(items, item_key, item_text)
    rows = bounded_rows(items.where(col(item_key).isNotNull() & col(item_text).isNotNull()).select(col(item_key).alias("k"), col(item_text).alias("t")).distinct(), MAX_ITEMS, "test items")
    kept = [(r["k"], w) for r in sorted(rows, key=lambda r: r["t"]) if len(w := split(r["t"])) >= LEAK]
    if sum(len(w) for _, w in kept) > MAX_ITEM_WORDS:
        raise ValueError("the test items are too long to be broadcast; split them")
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField(item_key, items.schema[item_key].dataType), T.StructField("n_words", T.IntegerType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((Items([w for _, w in kept]), [k for k, _ in kept]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, keys = shared.value
        reader = Reader(known)
        for b in batches:
            ids = b["k"].to_pylist()
            out = [(ids[i], keys[j], n, score) for i, j, n, score in search(reader, b["t"].to_pylist())]
            yield pa.RecordBatch.from_pydict({n: [x[c] for x in out] for c, n in enumerate((key, item_key, "n_words", "score"))}, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    found = docs.where(col(key).isNotNull() & col(text).isNotNull()).select(col(key).alias("k"), col(text).alias("t")).mapInArrow(run, schema)
    return found.groupBy(col(key), col(item_key)).agg(F.max("n_words").alias("n_words"), F.max("score").alias("score"))


def search(reader: Reader, texts: Sequence[str]) -> list[tuple[int, int, int, float]]:
    """(text, item, words, score) of all leaks in a batch of texts."""
    known = reader.items
    if not known.texts:
        return []
    if len(reader) > KEPT:
        reader.forget()
    raw, size = [], []
    for t in texts:
        w = (unmarked(t) if "<" in t or "&" in t else t).split()
        raw += w
        size.append(len(w))
    number = np.fromiter(map(reader.__getitem__, raw), np.int64, len(raw))
    full = np.array([len(w) > 0 for w in reader.word])[number] if len(number) else np.zeros(0, bool)
    text = np.repeat(np.arange(len(texts)), size)[full]
    number, size = number[full], np.bincount(text, minlength=len(texts))
    term, part, start = np.frombuffer(reader.term, np.int32)[number].astype(np.int64), np.frombuffer(reader.part, np.int8)[number], np.r_[0, np.cumsum(size)]
    # terms put together from neighbours, or taken apart, by position
    extra: dict[int, list[int]] = {}
    word, get = reader.word, known.term.get
    sure = np.zeros(len(number) + 1, bool)
    for m in range(2, TORN + 1):
        n = max(len(number) - m + 1, 0)
        for p in np.flatnonzero((part[:n] & 1 > 0) & (part[m - 1 :] & 2 > 0) & (text[:n] == text[m - 1 :])).tolist():
            if (j := get("".join([word[x] for x in number[p : p + m].tolist()]))) is not None:
                extra.setdefault(p, []).append(j)
                sure[p : p + m] = True
    if reader.apart:
        torn = np.zeros(len(word), bool)
        torn[list(reader.apart)] = True
        for p in np.flatnonzero(torn[number]).tolist():
            extra.setdefault(p, []).extend(reader.apart[int(number[p])])
            sure[p] = True
    width = known.index.width
    key = np.where((term[:-1] >= 0) & (term[1:] >= 0) & (text[:-1] == text[1:]), term[:-1] * width + term[1:], -1)
    beside = known.pairs[np.minimum(np.searchsorted(known.pairs, key), len(known.pairs) - 1)] == key
    beside |= (sure[:-2] | sure[1:-1]) & (text[:-1] == text[1:])
    unsure = np.r_[0, np.cumsum(sure[:-1])]
    term = np.where(np.r_[beside, False] | np.r_[False, beside], term, -1)
    most_of = known.index.term_max[term].astype(float)
    for p, js in extra.items():
        most_of[p] += known.index.term_max[js].sum()
    total = np.r_[0.0, np.cumsum(most_of)]
    windows = np.maximum(-(-(size - PASSAGE) // STRIDE) + 1, 1)
    of = np.repeat(np.arange(len(texts)), windows)
    begin = start[of] + STRIDE * (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows))
    end = np.minimum(begin + PASSAGE, start[of + 1])
    best: dict[int, dict[int, tuple[float, int, int]]] = {}
    where = np.array(sorted(extra), np.int64)
    # what an admissible piece holds besides: SURE words in a row, each after the one before in some item
    at = np.arange(len(beside))
    row = np.r_[0, np.cumsum(at - np.maximum.accumulate(np.where(beside, -1, at)) >= known.sure - 1)]
    row_from, row_to = np.minimum(begin + known.sure - 2, len(beside)), np.clip(end - 1, 0, len(beside))
    for i in np.flatnonzero((total[end] - total[begin] >= known.lowest * (1 - 1e-9)) & (row[row_to] > row[np.minimum(row_from, row_to)])).tolist():
        a, z = int(begin[i]), int(end[i])
        t = term[a:z]
        more = [j for p in where[np.searchsorted(where, a) : np.searchsorted(where, z)].tolist() for j in extra[p]]
        t = np.unique(np.r_[t[t >= 0], np.array(more, np.int64)])
        if known.index.term_max[t].sum() >= known.lowest * (1 - 1e-5):
            for j, score in zip(*map(np.ndarray.tolist, known.index.above(t, known.least, known.block_least))):
                found = best.setdefault(int(of[i]), {})
                s, x, y = found.get(j, (0.0, a, z))
                found[j] = max(score, s), min(x, a), max(y, z)
    out = []
    for i, found in best.items():
        streams: dict[tuple[int, int], Stream] = {}
        for j, (score, a, z) in found.items():
            item = known.aligned(j)
            # two changes leave all but four pairs of a piece as they are; where words were torn or run together, pairs prove nothing
            if not unsure[z] - unsure[a] and sum(map(item.pairs.__contains__, key[a : z - 1].tolist())) < known.paired:
                continue
            a, z = max(a - PASSAGE, int(start[i])), min(z + PASSAGE, int(start[i + 1]))
            if (a, z) not in streams:
                streams[a, z] = Stream([word[x] for x in number[a:z].tolist()])
            if n := leaked(streams[a, z], item):
                out.append((i, j, n, score))
    return out
