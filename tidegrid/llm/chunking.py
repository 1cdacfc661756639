"""Content-defined chunking of oversized texts at natural boundaries, with overlap.

A rolling hash over the last 32 code points marks landmarks wherever its lowest bits are zero. A piece ends at the first landmark past its minimum
size, snapped to the nearest natural boundary: a line end, or inside a line too long for any line end a gap between words, and only where there is
neither an arbitrary place (never between CR and LF). Cuts depend on the text around them, so an edit alters neighbouring pieces only.

Defined results: sizes are in code points; a null text or id gives no piece; a text of at most ``max_chars`` is one piece (method ``whole``), the empty text
too; a null start line gives null lines; the end line is counted from the text, whatever a table says. No other columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.common import col, require

WINDOW, LANDMARK_BITS = 32, 8
PIECES = "id string, piece int, start int, stop int, start_line int, end_line int, method string, longest_line int, text string"


def rolling_hash(codes: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW code points at each position: a shifted sum, built by doubling instead of position by position."""
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    width = 1
    while width < WINDOW:
        moved = np.zeros_like(h)
        moved[width:] = h[:-width] * np.uint64(pow(6364136223846793005, width, 1 << 64))
        h = h + moved
        width *= 2
    return h >> np.uint64(64 - LANDMARK_BITS)


def cuts(text: str, max_chars: int, overlap: int, min_chars: int) -> list[tuple[int, int, str]]:
    """Pieces (start, stop, method of the cut at stop) of a text longer than max_chars."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes)
    marks = np.flatnonzero(rolling_hash(codes) == 0) + 1
    lines = np.flatnonzero(codes == 10) + 1
    blank = np.isin(codes, (32, 9, 0xA0, 0x3000)) | np.isin(codes, tuple(map(ord, ",;)]}")))
    gaps = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    out, start = [], 0
    while n - start > max_chars:
        lo, hi = start + min_chars, start + max_chars
        i = np.searchsorted(marks, lo)
        want = int(marks[i]) if i < len(marks) and marks[i] <= hi else hi
        for places, method in ((lines, "line"), (gaps, "word")):
            a, b = np.searchsorted(places, lo), np.searchsorted(places, hi, side="right")
            if a == b:  # none past the minimum; any one that leaves something new will do
                a = np.searchsorted(places, start + overlap, side="right")
            if a < b:
                near = places[a:b]
                stop = int(near[np.argmin(np.abs(near - want))])
                break
        else:
            stop, method = want, "forced"
            if codes[stop - 1] == 13 and codes[stop] == 10:
                stop -= 1
        out.append((start, stop, method))
        start = stop - overlap
    out.append((start, n, "end"))
    return out


_END = re.compile(r"\r?\n")


def pieces_of(text: str, max_chars: int, overlap: int, min_chars: int) -> tuple[list[tuple[int, int, str, int, int]], int]:
    """(start, stop, method, lines before, line ends before the last character) of each piece, and the longest line, its end not counted."""
    longest = max(map(len, _END.split(text)))
    if len(text) <= max_chars:
        return [(0, len(text), "whole", 0, text.count("\n", 0, max(len(text) - 1, 0)))], longest
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    before = np.r_[0, np.cumsum(codes == 10)]
    return [(a, b, m, int(before[a]), int(before[b - 1])) for a, b, m in cuts(text, max_chars, overlap, min_chars)], longest


def split_texts(df: DataFrame, key: str, text: str, start_line: str | None = None, max_chars: int = 2000, overlap: int = 200, min_chars: int | None = None, only_oversized: bool = False) -> DataFrame:
    """One row per piece: code points [start, stop) of the text, its own lines, how its end was cut (line, word, forced; end for the last) and the
    length of the text's longest line. Short texts stay in the JVM; only oversized ones cross to Python, and nothing is shuffled."""
    require(df, key, text, *([start_line] if start_line else []))
    min_chars = min_chars or max_chars // 2
    if not 0 <= overlap < min_chars <= max_chars:
        raise ValueError("needs 0 <= overlap < min_chars <= max_chars")
    line = col(start_line).cast("int") if start_line else F.lit(1)
    rows = df.where(col(key).isNotNull() & col(text).isNotNull()).select(col(key).cast("string").alias("id"), line.alias("line"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {k.split(" ")[0]: [] for k in PIECES.split(", ")}
            size = 0
            for id_, at, t in zip(b["id"].to_pylist(), b["line"].to_pylist(), b["text"].to_pylist()):
                got, longest = pieces_of(t, max_chars, overlap, min_chars)
                for k, (lo, hi, method, above, below) in enumerate(got):
                    for c, v in zip(cols.values(), (id_, k, lo, hi, None if at is None else at + above, None if at is None else at + below, method, longest, t[lo:hi])):
                        c.append(v)
                    size += hi - lo
                if size > 4_000_000:
                    yield _batch(cols)
                    cols, size = {k: [] for k in cols}, 0
            yield _batch(cols)

    big = rows.where(F.length("text") > max_chars).mapInArrow(run, PIECES)
    if only_oversized:
        return big
    ends = F.size(F.split(F.when(F.length("text") > 0, F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text")), "\n")) - 1
    longest = F.array_max(F.transform(F.split("text", "\r?\n", -1), F.length))
    small = rows.where(F.length("text") <= max_chars).select("id", F.lit(0).alias("piece"), F.lit(0).alias("start"), F.length("text").alias("stop"), F.col("line").alias("start_line"), (F.col("line") + ends).cast("int").alias("end_line"), F.lit("whole").alias("method"), longest.cast("int").alias("longest_line"), "text")
    return small.unionByName(big)


_TYPES = pa.schema([("id", pa.string()), ("piece", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("start_line", pa.int32()), ("end_line", pa.int32()), ("method", pa.string()), ("longest_line", pa.int32()), ("text", pa.string())])


def _batch(cols: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(cols, schema=_TYPES)
