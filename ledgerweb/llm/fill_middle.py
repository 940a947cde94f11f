"""Fill-in-middle transformation, its cuts looked up in a learned rank index.

A text is a row of units, code points unless a pattern says otherwise. The byte offsets of all unit boundaries are fitted
by straight segments that pass every boundary within a given error (a shrinking cone from each segment's start, as in
Galakatos et al., SIGMOD 2019), and each boundary's residual is stored in a byte. A cut of rank r is then found without
walking the text: the segment predicts the offset, and the residual corrects it exactly. Boundaries are fitted a slice
at a time, so a text costs its own bytes, a byte for each boundary and a bounded rest.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerweb.llm.common import text_batches

SENTINELS = ("<P>", "<S>", "<M>")
ERROR = 127  # residuals are signed bytes
SLICE = 1 << 20
REACH = 1 << 12
BATCH_BYTES = 8 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def boundaries(text: bytes, pattern: re.Pattern | None = None) -> Iterator[np.ndarray]:
    """The byte offset at which each unit starts, in slices.

    Without a pattern units are code points. With one, a unit starts with each match, and text before the first
    match is a unit too; matches without a byte don't count.
    """
    if pattern is None:
        whole = np.frombuffer(text, dtype=np.uint8)
        for at in range(0, len(whole), SLICE):
            yield np.flatnonzero((whole[at:at + SLICE] & 0xC0) != 0x80) + at
        return
    starts = _starts(text, pattern)
    while len(found := np.fromiter(islice(starts, SLICE), dtype=np.int64)):
        yield found


def _starts(text: bytes, pattern: re.Pattern) -> Iterator[int]:
    at = (m.start() for m in pattern.finditer(text) if m.end() > m.start())
    first = next(at, None)
    if text and first != 0:
        yield 0
    if first is not None:
        yield first
    yield from at


def cone(offsets: np.ndarray, error: int) -> Iterator[tuple[int, int, float]]:
    """(first, end, slope) of segments: from its first point, a segment's line passes all its points within `error`."""
    first, count = 0, len(offsets)
    while first < count:
        low, high, end, reach = -np.inf, np.inf, first + 1, REACH
        while end < count:
            to = min(count, end + reach)
            run, rise = np.arange(end - first, to - first), offsets[end:to] - offsets[first]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            closed = lows > highs
            kept = int(closed.argmax()) if closed[-1] else len(closed)
            if kept:
                low, high, end = lows[kept - 1], highs[kept - 1], end + kept
            if kept < len(closed):
                break
            reach *= 2
        yield first, end, (low + high) / 2 if end > first + 1 else 0.0
        first = end


class RankIndex:
    """Offset of every unit boundary of one text by its rank: segments and residuals."""

    def __init__(self, text: bytes, pattern: re.Pattern | None = None, error: int = ERROR):
        self.firsts: list[int] = []
        self.lines: list[tuple[int, float]] = []
        residuals, self.units = [], 0
        for offsets in boundaries(text, pattern):
            for first, end, slope in cone(offsets, error):
                start = int(offsets[first])
                predicted = start + np.rint(slope * np.arange(end - first)).astype(np.int64)
                residuals.append((offsets[first:end] - predicted).astype(np.int8))
                self.firsts.append(self.units + first)
                self.lines.append((start, slope))
            self.units += len(offsets)
        self.residuals = np.concatenate(residuals) if residuals else np.zeros(0, dtype=np.int8)
        self.size = len(text)

    def offset(self, rank: int) -> int:
        """Where unit `rank` starts; the text's end for the rank after the last."""
        if rank >= self.units:
            return self.size
        at = bisect_right(self.firsts, rank) - 1
        start, slope = self.lines[at]
        return start + int(np.rint(slope * (rank - self.firsts[at]))) + int(self.residuals[rank])


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers out of the document's id; null counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def _checked(sentinels: tuple[str, str, str]) -> list[bytes]:
    """Sentinels that can be told from any text that holds none of them: no end of one begins another."""
    marks = [s.encode() for s in sentinels]
    overlap = any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b)) + (a is not b)))
    if len(set(marks)) != 3 or not all(marks) or overlap or any(a in b for a in marks for b in marks if a is not b):
        raise ValueError("three sentinels are needed of which none contains, or ends as, the beginning of another")
    return marks


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, sentinels: tuple[str, str, str] = SENTINELS,
                   unit: str | None = None, error: int = ERROR) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, output` for every row of `docs(doc_id, text)`.

    A text of n units is cut at two ranks drawn from doc_id; what lies between them goes to the end. `form` is `plain` (the
    text as it is; for empty texts, texts with a sentinel, and draws from `plain_from` of 100 on), `spm` (suffix, prefix, middle; draws
    below `spm_below` of 100) or `psm`. Lengths count units, and are null for plain texts. `unit` is a regular expression over UTF-8 bytes
    for other units than code points. Null texts count as empty; a null doc_id draws as the empty text. Repeated rows give a
    row each; other columns are ignored; no documents give no rows.
    """
    before, after, middle = _checked(sentinels)
    if not 0 < error <= ERROR:
        raise ValueError(f"residuals of one byte need an error of 1 to {ERROR}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(unit.encode()) if unit else None
        for batch in text_batches(batches, BATCH_BYTES):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                index = RankIndex(raw, pattern, error)
                h1, h2, h3, h4 = draws(doc_id, seed)
                if not raw or h3 % 100 >= plain_from or any(mark in raw for mark in (before, after, middle)):
                    rows.append((index.units, PLAIN, None, None, raw))
                    continue
                first, last = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
                a, b = index.offset(first), index.offset(last)
                if h4 % 100 < spm_below:
                    form, parts = SPM, (after, raw[b:], before, raw[:a], middle, raw[a:b])
                else:
                    form, parts = PSM, (before, raw[:a], after, raw[b:], middle, raw[a:b])
                rows.append((index.units, form, first, last - first, b"".join(parts)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            made = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            output = pa.Array.from_buffers(pa.string(), len(rows), made[-1].buffers())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made[:-1], output],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output and its form come from."""
    before, after, middle = sentinels

    def between(a: str, b: str) -> Column:
        return F.substring_index(F.substring_index(output, a, -1), b, 1)

    last = F.substring_index(output, middle, -1)
    return (
        F.when(form == PSM, F.concat(between(before, after), last, between(after, middle)))
        .when(form == SPM, F.concat(between(before, middle), last, between(after, before)))
        .otherwise(output)
    )
