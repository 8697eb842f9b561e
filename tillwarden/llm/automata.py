"""Suffix automata of reference passages, and the removal of words that they cover.

The automaton of a shard of passages accepts every substring of them. Streaming a document
through it gives matching statistics: at each word, the longest run of words ending there that
the shard holds. Each state also knows the smallest owner (document id) among the places of its
strings, so "held by an earlier document" is read off the state.

Two uses:

* ``without_passages``: a reference collection of checked size is cut into shards, whose
  automata every task gets by broadcast; documents stream through all of them.
* ``digest`` / earlier documents as the reference: the reference is the corpus itself, whose
  automata have no bound. passages.py settles equal segments by hash and sends segments that
  differ under one anchor to one shard; only these need an automaton, and no window can match
  in another shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm import passages
from tillwarden.llm.text import NO_ID, Chunk, chunk_of, chunks, keyed, real_id, unioned, words

WINDOW = 13
SHARD_WORDS = 50_000
#: A reference collection beyond this is refused: it wouldn't fit every task.
MOST_REFERENCE_WORDS = 5_000_000


class Automaton:
    """Suffix automaton of several sequences (no string crosses two of them)."""

    def __init__(self, sequences: Iterable[tuple[list[int], int]]):
        """sequences: (word hashes, owner)."""
        following: list[dict[int, int]] = [{}]
        link, size, least = [-1], [0], [NO_ID]
        for sequence, owner in sequences:
            last = 0
            for word in sequence:
                known = following[last].get(word)
                if known is not None and size[known] == size[last] + 1:
                    last = known
                    least[last] = min(least[last], owner)
                    continue
                if known is not None:
                    copy = len(size)
                    following.append(dict(following[known]))
                    link.append(link[known])
                    size.append(size[last] + 1)
                    least.append(owner)
                    link[known] = copy
                    at = last
                    while at >= 0 and following[at].get(word) == known:
                        following[at][word] = copy
                        at = link[at]
                    last = copy
                    continue
                new = len(size)
                following.append({})
                size.append(size[last] + 1)
                link.append(0)
                least.append(owner)
                at = last
                while at >= 0 and word not in following[at]:
                    following[at][word] = new
                    at = link[at]
                if at >= 0:
                    there = following[at][word]
                    if size[there] == size[at] + 1:
                        link[new] = there
                    else:
                        copy = len(size)
                        following.append(dict(following[there]))
                        link.append(link[there])
                        size.append(size[at] + 1)
                        least.append(NO_ID)
                        link[there] = link[new] = copy
                        while at >= 0 and following[at].get(word) == there:
                            following[at][word] = copy
                            at = link[at]
                last = new
        # A state's strings are suffixes of those of the states that link to it.
        for state in sorted(range(1, len(size)), key=size.__getitem__, reverse=True):
            if least[state] < least[link[state]]:
                least[link[state]] = least[state]
        self.following, self.link, self.size, self.least = following, link, size, least

    def covered(self, sequence: list[int], length: int, owner: int = NO_ID) -> list[int]:
        """Starts of all windows of ``length`` that a smaller owner holds."""
        following, link, size, least = self.following, self.link, self.size, self.least
        state = held = 0
        found = []
        for at, word in enumerate(sequence):
            target = following[state].get(word)
            while target is None and state:
                state = link[state]
                held = size[state]
                target = following[state].get(word)
            if target is None:
                continue
            state, held = target, held + 1
            if held >= length:
                while size[link[state]] >= length:
                    state = link[state]
                held = min(held, size[state])
                if least[state] < owner:
                    found.append(at - length + 1)
        return found


def scheme(window: int = WINDOW) -> passages.Scheme:
    return passages.Scheme("word", window, max(1, min(5, window // 2)), "earlier")


def _runs(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (owner, start) as (owner, first start, count)."""
    if not len(owner):
        return owner, start, start
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    return owner[head], start[head], np.diff(np.append(head, len(owner)))


def _compare(window: int):
    def compare(batches):
        for run in passages.request_runs(batches, 8 * SHARD_WORDS):
            sequences = [np.frombuffer(r.content, np.uint64).tolist() for r in run]
            shard = Automaton(zip(sequences, (r.id for r in run), strict=True))
            found = [shard.covered(s, window, r.id) for s, r in zip(sequences, run, strict=True)]
            owner = np.repeat(np.arange(len(run)), [len(f) for f in found])
            start = np.array([x for f in found for x in f], np.int64)
            owner, start, n = _runs(owner, start)
            yield passages.ranges(run, owner, np.array([r.start for r in run], np.int64)[owner] + start, n)

    return compare


def _kept(chunk: Chunk, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words, removed words, and the kept words joined by a space, of each text; the spans
    (row, first word, end word) are removed."""
    w = words(chunk)
    gone = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(gone, w.first[row] + start, 1)
    np.add.at(gone, w.first[row] + end, -1)
    gone = np.cumsum(gone)[:-1] > 0
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
    left = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        stay = np.flatnonzero(~gone[a:b]) + a
        left.append(b" ".join([chunk.data[x:y].tobytes() for x, y in zip(w.start[stay], w.end[stay], strict=True)]) if len(stay) < b - a else None)
        if left[-1] is None:
            begin = w.start[a] if b > a else 0
            text = chunk.data[begin : w.end[b - 1]].tobytes() if b > a else b""
            left[-1] = b" ".join(text.split())
    return w.counts, removed, left


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per row of ``docs``.

    Removed is each word covered by ``window`` words that also start in a document with a
    smaller doc_id; windows are judged on the input. A missing text has no words. Rows that
    share an id take nothing from each other; a missing id is larger than all others.
    """

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                counts, removed, left = _kept(chunk_of(batch, "_text"), *passages.spans(scheme(window), batch))
                digests = pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(counts), pa.array(removed), digests], ["_id", "n_words", "n_removed", "kept_sha256"]
                )

    rows = keyed(docs)
    rows = passages.with_ranges(rows, passages.find(rows, scheme(window), _compare(window)))
    found = rows.select("_id", "_text", "_starts", "_counts").mapInArrow(run, "_id long, n_words long, n_removed long, kept_sha256 string")
    return found.select(real_id(), "n_words", "n_removed", "kept_sha256")


def shards(reference: DataFrame, most_words: int = MOST_REFERENCE_WORDS) -> list[list[list[int]]]:
    """Word hashes of all distinct reference texts, in shards of about SHARD_WORDS words. A
    reference of more than ``most_words`` words is refused before any text is read."""

    def count(batches):
        for chunk in chunks(batches, "_text"):
            yield pa.RecordBatch.from_arrays([pa.array([int(words(chunk).first[-1])], pa.int64())], ["n"])

    texts = keyed(reference).select("_text").distinct()
    total = texts.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    if total > most_words:
        raise ValueError(f"the reference has {total} words; at most {most_words} can be broadcast")
    out: list[list[list[int]]] = [[]]
    held = 0
    for batch in texts.toArrow().to_batches():
        for chunk in chunks(iter([batch]), "_text"):
            w = words(chunk)
            for a, b in zip(w.first[:-1], w.first[1:], strict=True):
                if held > SHARD_WORDS:
                    out.append([])
                    held = 0
                out[-1].append(w.hashes[a:b].tolist())
                held += int(b - a)
    return out


def without_passages(docs: DataFrame, reference: DataFrame, window: int = WINDOW, most_words: int = MOST_REFERENCE_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text: words of ``docs`` covered by ``window`` words that
    a text of ``reference`` (column text) holds are removed; kept words are joined by one space."""
    sent = docs.sparkSession.sparkContext.broadcast(shards(reference, most_words))

    def run(batches):
        built = [Automaton((s, 0) for s in shard) for shard in sent.value]
        for chunk in chunks(batches, "_text"):
            w = words(chunk)
            row, start = [], []
            for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                sequence = w.hashes[a:b].tolist()
                hits = [x for shard in built for x in shard.covered(sequence, window)]
                start += hits
                row += [i] * len(hits)
            start = np.array(start, np.int64)
            counts, removed, left = _kept(chunk, *unioned(np.array(row, np.int64), start, start + window))
            texts = pa.array([x.decode() for x in left], pa.string())
            yield pa.RecordBatch.from_arrays(
                [chunk.batch.column("_id"), pa.array(counts), pa.array(removed), texts], ["_id", "n_words", "n_removed", "kept_text"]
            )

    found = keyed(docs).mapInArrow(run, "_id long, n_words long, n_removed long, kept_text string")
    return found.select(real_id(), "n_words", "n_removed", "kept_text")
