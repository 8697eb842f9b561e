"""Suffix arrays in a logarithmic family, and the removal of long repeated strings.

A family keeps levels of suffix arrays. A new batch gets its own array, is merge-scanned against
every level for matches of at least ``length``, and becomes a level; two levels of about equal
size are merged, so there are only logarithmically many and each suffix is merged
logarithmically often. Only the first ``length`` bytes of a suffix decide a match of that
length, so arrays are ordered by these.

Corpus wide, passages.py settles equal segments by hash and sends only those segments to a
family whose windows could still be equal in part; equal windows always meet in one family.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillwarden.llm import passages
from tillwarden.llm.text import chunk_of, key_columns, keyed, real_id, wrapped

LENGTH = 400
#: Bytes that make one batch of a family.
BATCH_BYTES = 96 << 10


@dataclass
class Level:
    """A suffix array: sorted prefixes, and for each the label of its suffix and whether it has matched."""

    keys: np.ndarray
    labels: np.ndarray
    matched: np.ndarray


def suffix_array(data: np.ndarray, starts: np.ndarray, labels: np.ndarray, length: int) -> Level:
    """The suffixes at ``starts`` (each with ``length`` bytes left), ordered by these bytes."""
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    keys = np.ascontiguousarray(windows[starts]).view(f"S{length}").ravel()
    order = np.argsort(keys, kind="stable")
    return Level(keys[order], labels[order], np.zeros(len(order), bool))


class SuffixFamily:
    """Levels for one run of batches. ``levels`` is ordered from large to small."""

    def __init__(self, length: int):
        self.length = length
        self.levels: list[Level] = []

    def add(self, data: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Index a batch; returns the labels of all suffixes, old and new, that have found an
        equal one for the first time."""
        if not len(starts):
            return labels[:0]
        batch = suffix_array(data, starts, labels, self.length)
        same = batch.keys[1:] == batch.keys[:-1]
        batch.matched[1:] |= same
        batch.matched[:-1] |= same
        found = []
        for level in self.levels:
            low = np.searchsorted(level.keys, batch.keys, "left")
            hit = level.keys[np.minimum(low, len(level.keys) - 1)] == batch.keys
            batch.matched |= hit & (low < len(level.keys))
            high = np.searchsorted(level.keys, batch.keys[hit], "right")
            marks = np.zeros(len(level.keys) + 1, np.int64)
            np.add.at(marks, low[hit], 1)
            np.add.at(marks, high, -1)
            fresh = (np.cumsum(marks)[:-1] > 0) & ~level.matched
            found.append(level.labels[fresh])
            level.matched |= fresh
        found.append(batch.labels[batch.matched])
        self.levels.append(batch)
        while len(self.levels) > 1 and len(self.levels[-2].keys) < 2 * len(self.levels[-1].keys):
            self._merge()
        return np.concatenate(found)

    def _merge(self) -> None:
        b, a = self.levels.pop(), self.levels.pop()
        at = np.searchsorted(a.keys, b.keys, "right")
        self.levels.append(Level(*(np.insert(x, at, y) for x, y in ((a.keys, b.keys), (a.labels, b.labels), (a.matched, b.matched)))))


def scheme(length: int = LENGTH) -> passages.Scheme:
    return passages.Scheme("byte", length, max(1, min(128, length // 3)), "elsewhere")


def _compare(length: int):
    def compare(batches):
        for run in passages.request_runs(batches, 4 * BATCH_BYTES):
            family = SuffixFamily(length)
            counts = np.array([r.n for r in run], np.int64)
            base = np.cumsum(counts) - counts
            covered = np.zeros(int(counts.sum()), bool)
            at = 0
            while at < len(run):
                stop, held = at, 0
                while stop < len(run) and (stop == at or held < BATCH_BYTES):
                    held += len(run[stop].content)
                    stop += 1
                some = run[at:stop]
                data = np.frombuffer(b"".join(r.content for r in some), np.uint8)
                sizes = np.array([len(r.content) for r in some], np.int64)
                n = counts[at:stop]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                starts = np.repeat(np.cumsum(sizes) - sizes, n) + step
                covered[family.add(data, starts, np.repeat(base[at:stop], n) + step)] = True
                at = stop
            owner = np.repeat(np.arange(len(run)), counts)
            covered &= ~np.array([r.known for r in run])[owner]
            edge = np.flatnonzero(covered & ~np.concatenate([[False], covered[:-1] & (owner[1:] == owner[:-1])]))
            last = np.flatnonzero(covered & ~np.concatenate([covered[1:] & (owner[1:] == owner[:-1]), [False]]))
            begin = np.array([r.start for r in run], np.int64)[owner[edge]] + edge - base[owner[edge]]
            yield passages.ranges(run, owner[edge], begin, last - edge + 1)

    return compare


def _found(docs: DataFrame, length: int) -> DataFrame:
    """Covered ranges of window starts of ``docs`` (see passages.find)."""
    return passages.find(keyed(docs), scheme(length), _compare(length))


def _cut(batches, length: int, column: str):
    """(batch, text bytes and removed spans of each row)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            chunk = chunk_of(batch, column)
            row, start, end = passages.spans(scheme(length), batch)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = [list(zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield batch, [(chunk.bytes_of(i), s) for i, s in enumerate(spans)]


def _left(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per row of ``docs``.

    Removed is each byte covered by a ``length``-byte string that also starts anywhere else in
    the table, in the same text too; strings are judged on the input. A missing text is empty. A
    repeated row is another place, so all its strings go. Missing ids stay missing.
    """

    def run(batches):
        for batch, texts in _cut(batches, length, "_text"):
            left = [_left(t, s) for t, s in texts]
            columns = [
                pa.array([len(t) for t, _ in texts], pa.int64()),
                pa.array([len(t) - len(k) for (t, _), k in zip(texts, left, strict=True)], pa.int64()),
                pa.array([len(s) for _, s in texts], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in left], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = passages.with_ranges(keyed(docs), _found(docs, length)).select("_id", "_text", "_starts", "_counts")
    found = rows.mapInArrow(run, "_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return found.select(real_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the same columns and rows; ``text`` loses the covered bytes. Where a removed
    string begins or ends inside a character, what is left of that character goes too. Texts
    without a removed byte stay as they are (missing ones missing); ``n_chars``, if there, is
    counted anew for the others."""

    rows = wrapped(docs).withColumns(key_columns("row.text", "row.doc_id"))
    rows = passages.with_ranges(rows, _found(docs, length)).select("row", "_starts", "_counts")

    def run(batches):
        for batch, texts in _cut(batches, length, "row.text"):
            left = [_left(t, s).decode("utf-8", "ignore") if s else None for t, s in texts]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(left, pa.string())], ["row", "_left"])

    out = rows.mapInArrow(run, StructType([rows.schema["row"], StructField("_left", StringType())]))
    values = {"text": F.coalesce("_left", "row.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col("_left").isNotNull(), F.char_length("_left").cast(kind)).otherwise(F.col("row.n_chars"))
    return out.select(*(values.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
