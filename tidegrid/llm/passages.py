"""Words and passages of a text, read for what they say: disguises are undone word by word, and every word is worked out once.

A text is cut at line ends, sentence ends, emoticons, dashes and speaker marks; what is still long is cut into overlapping windows. Words have look-alike letters,
digits for letters, masks inside and repeated letters undone, and single slips of the pen against the known vocabulary. Passages that are spelt out letter by letter,
or write digits for letters throughout, are read as a whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

from tidegrid.llm.canonical import unmarked, worded

LONG, WINDOW = 22, 14
#: Words kept with what they mean; beyond it all are forgotten and worked out anew, to the same result.
KEPT = 400_000

_INSIDE = re.compile(r"(?<=\w)[*#.,·_'’`´~^\-]+(?=\w)")
_TOKEN = re.compile(r"[^\W_]+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_*]+){2,}[^\W_](?![^\W_])")
_RUN = re.compile(r"(.)\1+")
_LEET = str.maketrans("013457891@$!|l", "oieastbgiasiii")
_MIX = re.compile(r"(?=.*[^\W\d_])(?=.*[\d@$!])")
_SYMBOL = re.compile(r"(?<=\w)[@$!](?=\w)|[@$](?=\w)|(?<=\w)[@$]")
_END = re.compile(r"(?:[.!?]+[\"'»”)]*|\.{2,}|[:;]-?[()DP])$")
_SPEAKER = re.compile(r"[A-Z]:")

#: Kinds of words: a passage ends after it, it is one letter, it writes digits for letters, it marks a speaker.
END, ONE, MIX, SPEAKER = 1, 2, 4, 8


def fold(word: str) -> str:
    return _RUN.sub(r"\1", word.translate(_LEET))


def tokens(passage: str) -> list[str]:
    """Folded words of a passage. Numbers are dropped, unless the passage writes digits for letters throughout."""
    t = worded(unmarked(passage))
    t = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]+", "", m.group()), t)
    t = _INSIDE.sub("", t)
    t = _SYMBOL.sub(lambda m: m.group().translate(_LEET), t)
    raw = _TOKEN.findall(t)
    leet = sum(1 for w in raw if _MIX.match(w)) >= 3
    return [fold(w) for w in raw if leet or not w.isdigit()]


def slips(word: str) -> set[str]:
    """The word without any one of its letters: two words that are one slip apart share one of these or the word itself."""
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


@dataclass
class Passages:
    """Passages of a batch of texts: ``numbers[start[i]:start[i + 1]]`` are the words of passage i, of text ``text[i]``; ``raw[first[i]:last[i]]`` is how they are written."""

    numbers: np.ndarray
    start: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    raw: list[str]

    def __len__(self) -> int:
        return len(self.text)

    def written(self, i: int) -> str:
        return " ".join(self.raw[self.first[i] : self.last[i]])


class Reader(dict):
    """Reads texts as passages of numbered words. With a vocabulary, words outside it are 0; without one, every word gets a number. As a dict, the code of each written
    word that was read; by code, its kind and the numbers of its words."""

    def __init__(self, vocabulary: Iterable[str] | None = None):
        super().__init__()
        self.open = vocabulary is None
        self.number: dict[str, int] = {w: i for i, w in enumerate(sorted(vocabulary or ()), 1)}
        self.near: dict[str, int] = {}
        for w, i in self.number.items():
            if len(w) >= 4:
                for s in slips(w):
                    if len(s) >= 4:
                        self.near.setdefault(s, i)
        self.forget()

    def __reduce__(self) -> tuple:
        return Reader, (None if self.open else list(self.number),)

    def forget(self) -> None:
        self.clear()
        self.kind, self.at, self.words = array("b"), array("i", [0]), array("i")

    def of(self, word: str) -> int:
        """The number of a folded word, or of the vocabulary's word that is one slip away; 0 if there is none."""
        got = self.number.get(word, 0)
        if self.open and not got:
            return self.number.setdefault(word, len(self.number) + 1)
        if got or len(word) < 4:
            return got
        got = self.near.get(word, 0)
        if not got and len(word) >= 5:
            for s in sorted(slips(word)):
                if len(s) >= 4 and (got := self.number.get(s, 0) or self.near.get(s, 0)):
                    break
        return got

    def __missing__(self, raw: str) -> int:
        letters = _TOKEN.findall(worded(raw))
        one = len(letters) == 1 and len(letters[0]) == 1
        kind = ONE if one else 0
        if _END.search(raw) and not one or raw in ("-", "–", "—", "|"):
            kind |= END
        if any(map(_MIX.match, letters)) or _MIX.match(raw.strip(".,;:!?\"'()")):
            kind |= MIX
        if _SPEAKER.fullmatch(raw):
            kind |= SPEAKER
        code = len(self.kind)
        self.kind.append(kind)
        self.words.extend(map(self.of, tokens(raw)))
        self.at.append(len(self.words))
        self[raw] = code
        return code

    def batch(self, texts: Sequence[str | None]) -> Passages:
        if len(self) > KEPT:
            self.forget()
        raw: list[str] = []
        sizes: list[int] = []
        lines = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            if t:
                if "<" in t or "&" in t:
                    t = unmarked(t)
                for line in t.splitlines():
                    if w := line.split():
                        raw += w
                        sizes.append(len(w))
                        lines[i] += 1
        n = len(raw)
        if not n:
            none = np.zeros(0, np.int64)
            return Passages(none, np.zeros(1, np.int64), none, none, none, raw)
        code = np.fromiter(map(self.__getitem__, raw), np.int64, n)
        kind, at = np.frombuffer(self.kind, np.int8)[code], np.frombuffer(self.at, np.int32)
        begin = np.r_[0, np.cumsum(sizes)]
        ends = (kind & END) > 0
        ends[begin[1:] - 1] = True
        last = np.flatnonzero(ends) + 1
        first = np.r_[0, last[:-1]]
        line = np.searchsorted(begin, first, "right") - 1
        marked = (first == begin[line]) & ((kind[first] & SPEAKER) > 0)
        text = np.repeat(np.arange(len(texts)), lines)[line]
        count = at[code + 1] - at[code]
        count[first[marked]] = 0
        total = np.r_[0, np.cumsum(count)]
        numbers = np.frombuffer(self.words, np.int32)[np.repeat(at[code] - total[:-1], count) + np.arange(total[-1])] if total[-1] else np.zeros(0, np.int32)
        first = first + marked
        ones, mixes = np.add.reduceat((kind & ONE) > 0, np.minimum(first, n - 1), dtype=np.int64), np.add.reduceat((kind & MIX) > 0, np.minimum(first, n - 1), dtype=np.int64)
        odd = (first < last) & ((ones >= 3) | (mixes >= 3) | (last - first > LONG))
        plain = ~odd & (total[last] > total[first])
        more = [c for i in np.flatnonzero(odd).tolist() for c in self._odd(raw, int(first[i]), int(last[i]), 3 <= ones[i] and 2 * ones[i] > last[i] - first[i], ones[i] >= 3 or mixes[i] >= 3, int(text[i]), numbers, total)]
        size = np.r_[(total[last] - total[first])[plain], np.array([len(m[0]) for m in more], np.int64)]
        use = np.repeat(plain, total[last] - total[np.r_[0, last[:-1]]]) if len(numbers) else np.zeros(0, bool)
        each = lambda a, k: np.r_[a[plain], np.array([m[k] for m in more], np.int64)]
        return Passages(
            np.r_[numbers[use], np.array([x for m in more for x in m[0]], np.int64)].astype(np.int64), np.r_[0, np.cumsum(size)].astype(np.int64), each(text, 1), each(first, 2), each(last, 3), raw
        )

    def _odd(self, raw: list[str], a: int, z: int, spelt: bool, digits: bool, text: int, numbers: np.ndarray, total: np.ndarray) -> list[tuple[list[int], int, int, int]]:
        """A passage that is spelt out, written with digits, or long."""
        out = []
        long = z - a > LONG and not spelt
        for k in range(a, max(z - WINDOW // 2, a + 1), WINDOW // 2) if long else (a,):
            end = min(k + WINDOW, z) if long else z
            n = list(map(self.of, tokens(" ".join(raw[k:end])))) if spelt or digits else numbers[total[k] : total[end]].tolist()
            if n:
                out.append((n, text, k, end))
        return out
