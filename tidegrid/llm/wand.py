"""A block-max inverted index over a bounded set of short texts, and exact retrieval from it.

The posting list of a term is cut into blocks of neighbouring texts, and each list keeps the largest weight of every block that it reaches, nothing for the others: the index is as
large as its postings. A block whose summed maxima cannot reach the threshold is never scored (Ding and Suel 2011), so nothing above it is lost. What a pivot does text by text
in WAND is done here for all blocks of a list at once: the lists' block entries are added up, and postings are read only where the sum is enough."""

from __future__ import annotations

import numpy as np


def segments(start: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the segments ``of`` one after another, and the border of each among them."""
    size = start[of + 1] - start[of]
    border = np.r_[0, np.cumsum(size)]
    return np.repeat(start[of] - border[:-1], size) + np.arange(border[-1]), border


class BlockMaxIndex:
    """Postings (term, id, weight), no pair of term and id twice, ids from 0 to size - 1, terms from 0 to width - 1."""

    def __init__(self, term: np.ndarray, ids: np.ndarray, weight: np.ndarray, width: int, size: int, block: int):
        by = np.lexsort((ids, term))
        term, self.ids, self.weights = term[by], ids[by].astype(np.int32), weight[by].astype(np.float32)
        self.size, self.width, self.block, self.blocks = size, width, block, -(-max(size, 1) // block)
        self.post = np.r_[0, np.cumsum(np.bincount(term, minlength=width))]
        key = term.astype(np.int64) * self.blocks + self.ids // block
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        #: by block entry: its block, its largest weight, and where its postings lie
        self.entry_block = (key[first] % self.blocks).astype(np.int32)
        self.entry_max = np.nextafter(np.maximum.reduceat(self.weights, first), np.float32(np.inf)) if len(first) else np.zeros(0, np.float32)
        self.entry_post = np.r_[first, len(key)]
        self.entry = np.r_[0, np.cumsum(np.bincount(term[first], minlength=width))]
        #: by term, its largest weight; one more for unknown terms
        self.term_max = np.zeros(width + 1, np.float32)
        np.maximum.at(self.term_max, term, np.nextafter(self.weights, np.float32(np.inf)))

    def bounds(self, t: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By block, the most that any of its texts can score for terms ``t`` of weights ``q``; and the entries added up for it, with their weights."""
        e, border = segments(self.entry, t)
        w = np.repeat(q, np.diff(border))
        return np.bincount(self.entry_block[e], self.entry_max[e] * w, self.blocks) * (1 + 1e-5), e, w

    def scores(self, chosen: np.ndarray, e: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of all texts of the ``chosen`` blocks (a flag a block), zeros included; ``e`` and ``w`` as ``bounds`` gives them."""
        keep = chosen[self.entry_block[e]]
        e, w = e[keep], w[keep]
        at, border = segments(self.entry_post, e)
        blocks = np.flatnonzero(chosen)
        slot = np.zeros(self.blocks, np.int64)
        slot[blocks] = np.arange(len(blocks)) * self.block
        size = np.diff(border)
        cell = np.repeat(slot[self.entry_block[e]] - self.entry_block[e].astype(np.int64) * self.block, size) + self.ids[at]
        score = np.bincount(cell, self.weights[at] * np.repeat(w, size), len(blocks) * self.block)
        return (blocks[:, None] * self.block + np.arange(self.block)).ravel(), score

    def above(self, t: np.ndarray, least: np.ndarray, block_least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts whose score for these distinct terms is at least their own threshold ``least``, and the scores. ``block_least``: its minimum by block."""
        bound, e, w = self.bounds(t, np.ones(len(t), np.float32))
        live = (bound >= block_least) & (bound > 0)
        if not live.any():
            return np.zeros(0, np.int64), np.zeros(0)
        ids, score = self.scores(live, e, w)
        own = np.r_[least, np.full(self.blocks * self.block - self.size, np.inf)][ids]
        hit = np.flatnonzero((score >= own) & (score > 0))
        return ids[hit], score[hit]

    def least_by_block(self, least: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(least, np.arange(0, self.size, self.block)) if self.size else np.full(self.blocks, np.inf)

    def largest(self, t: np.ndarray, q: np.ndarray, k: int, floor: float, first: int, ahead: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the k texts that score most, of those with ``floor`` or more, exact: the ``first`` most promising blocks set the bar, then every block that may
        hold something over it is scored. Nothing is given when k texts score more than ``ahead``, if that is set."""
        bound, e, w = self.bounds(t, q)
        live = bound >= floor
        chosen = live.copy()
        if live.sum() > first:
            chosen[np.argpartition(bound, self.blocks - first)[: self.blocks - first]] = False
        ids, score = self.scores(chosen, e, w)
        bar = max(float(np.partition(score, len(score) - k)[len(score) - k]) if len(score) > k else 0.0, floor)
        if ahead and bar > ahead:
            return np.zeros(0, np.int64), np.zeros(0)
        more = live & ~chosen & (bound >= bar)
        if more.any():
            i, s = self.scores(more, e, w)
            ids, score = np.r_[ids, i], np.r_[score, s]
        hit = np.flatnonzero(score >= bar)
        hit = hit[np.lexsort((ids[hit], -score[hit]))[:k]]
        return ids[hit], score[hit]
