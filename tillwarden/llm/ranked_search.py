"""Ranked lexical search over an index that is stratified by document length.

Documents with the same length normaliser m form a stratum. In it a posting list is ordered by
term frequency, so the impact of a frequency is worked out once for all documents that have it,
and the highest frequency of each term bounds what any document of the stratum can score. A
search visits strata by falling bound and leaves out those that can't reach its results any more.

A document scores ``sum(w * ((10**9 * tf) div (1000 * tf + 12 * m)))`` over the words of the
question, with m = 75 + (25 * n * N) div L for n of its terms, N documents and L terms in all.
Questions are sent to the tasks in blocks of bounded size; for one block the index holds
the postings of the block's words, of every document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.llm.text import NO_ID, Chunk, chunks, lowered, words
from tillwarden.session import materialise

#: ASCII bytes other than letters and digits stand between terms; constants of the score.
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[:0x80] = [not chr(b).isalnum() for b in range(0x80)]
SHARE, PERCENT = 25, 100
IMPACT, PER_TF, PER_M = 10**9, 1000, 12
#: Documents whose strata a task holds at once.
RUN_DOCS = 1 << 16


@dataclass(frozen=True)
class SearchSettings:
    """top: results per question. block_words: most words of questions that are sent at once."""

    top: int = 20
    block_words: int = 200_000


@dataclass
class Questions:
    """One block: the hashes of its words, ascending, and for each question its key, its words as
    indexes of these and how often it names each."""

    vocabulary: np.ndarray
    keys: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def terms(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and each document's first."""
    found = words(lowered(chunk), _OUTSIDE)
    return found.hashes, found.first


def _asked(items: DataFrame, block_words: int) -> Iterator[tuple[Questions, dict[int, int]]]:
    """Blocks of questions with at least one term, and the id of each question's key. Equal rows
    are one question. The driver reads one partition at a time and holds one block."""
    rows = items.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    block: list[np.ndarray] = []
    ids: dict[int, int] = {}
    held = 0

    def closed() -> tuple[Questions, dict[int, int]]:
        vocabulary = np.unique(np.concatenate(block))
        bags = [np.unique(np.searchsorted(vocabulary, b), return_counts=True) for b in block]
        return Questions(vocabulary, list(ids), [t for t, _ in bags], [n for _, n in bags]), ids

    for row in rows.toLocalIterator():
        data = np.frombuffer(row["text"].encode(), np.uint8)
        hashes, _ = terms(Chunk(None, data, np.array([0, len(data)])))
        if not len(hashes):
            continue
        if held and held + len(hashes) > block_words:
            yield closed()
            block, ids, held = [], {}, 0
        ids[len(block)] = row["item_id"]
        block.append(hashes)
        held += len(hashes)
    if block:
        yield closed()


_POSTED = "_id long, n long, terms array<int>, tfs array<int>"


def _posted(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """_id, n (all terms of the document), and the asked terms in it with their frequencies;
    documents without any term are left out, those without an asked one are not."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        known = sent.value
        for chunk in chunks(batches, "_text"):
            hashes, first = terms(chunk)
            n = np.diff(first)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.flatnonzero(known[at] == hashes)
            document = np.repeat(np.arange(len(n)), n)
            pair, tf = np.unique(document[hit] * len(known) + at[hit], return_counts=True)
            held = np.flatnonzero(n)
            offsets = np.append(np.searchsorted(pair, held * len(known)), len(pair)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (pair % len(known), tf)]
            ids = chunk.column("_id")[held]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[held].astype(np.int64)), *lists], ["_id", "n", "terms", "tfs"])

    return docs.mapInArrow(count, _POSTED)


def _frequencies(posted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequency of every word of the block (the driver holds one number
    per word)."""
    whole = posted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    df = np.zeros(size, np.int64)
    rows = posted.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in rows.toLocalIterator():
        df[row["term"]] = row["df"]
    return whole[0], whole[1], df


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Stratum:
    """Documents of one normaliser: for each term its postings by falling frequency, with the impact of each."""

    def __init__(self, m: int, ids: np.ndarray, document: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.m, self.ids = m, ids
        order = np.lexsort((-tf, term))
        self.document, tf = document[order], tf[order]
        self.terms, self.first = np.unique(term[order], return_index=True)
        self.end = np.append(self.first[1:], len(order))
        different, place = np.unique(tf, return_inverse=True)
        impact = (IMPACT * different) // (PER_TF * different + PER_M * m)
        self.impact = impact[place]

    def _places(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(len(asked), bool)
        at = np.minimum(np.searchsorted(self.terms, asked), len(self.terms) - 1)
        held = self.terms[at] == asked
        return at[held], held

    def bound(self, asked: np.ndarray, gain: np.ndarray) -> int:
        """No document scores more: each term at its highest impact."""
        at, held = self._places(asked)
        return int((gain[held] * self.impact[self.first[at]]).sum())

    def scores(self, asked: np.ndarray, gain: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.ids), np.int64)
        at, held = self._places(asked)
        for place, w in zip(at.tolist(), gain[held].tolist(), strict=True):
            a, b = self.first[place], self.end[place]
            total[self.document[a:b]] += w * self.impact[a:b]
        return total


class Best:
    """The ``top`` highest scores above 0 seen so far, equal ones by ascending id."""

    def __init__(self, top: int):
        self.top = top
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a document must reach at least."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def take(self, ids: np.ndarray, scores: np.ndarray) -> None:
        some = scores >= self.least
        ids, scores = np.concatenate([self.ids, ids[some]]), np.concatenate([self.scores, scores[some]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.ids, self.scores = ids[order], scores[order]


def _strata(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Stratum]]:
    """Strata of about RUN_DOCS documents at a time; rows come sorted by m."""
    held: list[pa.RecordBatch] = []

    def built() -> list[Stratum]:
        table = pa.Table.from_batches(held).combine_chunks()
        m, ids = (table.column(c).to_numpy() for c in ("m", "_id"))
        lists = table.column("terms").combine_chunks()
        document = np.repeat(np.arange(len(m)), lists.value_lengths().to_numpy())
        term, tf = (table.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
        cuts = np.append(np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])), len(m))
        places = np.searchsorted(document, cuts)
        return [
            Stratum(int(m[a]), ids[a:b], document[p:q] - a, term[p:q], tf[p:q])
            for a, b, p, q in zip(cuts[:-1], cuts[1:], places[:-1], places[1:], strict=True)
        ]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= RUN_DOCS:
            yield built()
            held = []
    if sum(b.num_rows for b in held):
        yield built()


_FOUND = "key int, _id long, score long"


def _searched(posted: DataFrame, questions: Questions, settings: SearchSettings) -> DataFrame:
    """key, rank, _id, score: the best documents of every question of the block."""
    spark = posted.sparkSession
    n_docs, n_terms, df = _frequencies(posted, len(questions.vocabulary))
    weight = weights(df, n_docs)
    sent = spark.sparkContext.broadcast((questions.terms, [weight[t] * n for t, n in zip(questions.terms, questions.repeats, strict=True)]))
    m = F.lit(PERCENT - SHARE) + F.expr(f"(({SHARE}L * n * {n_docs}L) div {max(1, n_terms)}L)")
    # By m first, so that a task has few strata; by a hash next, so that one of them can't fill a task.
    stratified = posted.where(F.size("terms") > 0).withColumns({"m": m, "_part": F.xxhash64("_id")})
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stratified = stratified.repartitionByRange(tasks, "m", "_part").sortWithinPartitions("m").select("m", "_id", "terms", "tfs")

    def search(batches):
        asked, gains = sent.value
        best = [Best(settings.top) for _ in asked]
        for strata in _strata(batches):
            for own, question, gain in zip(best, asked, gains, strict=True):
                bounds = np.array([s.bound(question, gain) for s in strata])
                for place in np.argsort(-bounds, kind="stable").tolist():
                    if bounds[place] < own.least:
                        break
                    own.take(strata[place].ids, strata[place].scores(question, gain))
        key = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.ids) for b in best])
        ids, scores = (np.concatenate([getattr(b, f) for b in best]) for f in ("ids", "scores"))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), pa.array(scores)], ["key", "_id", "score"])

    order = Window.partitionBy("key").orderBy(F.col("score").desc(), "_id")
    found = stratified.mapInArrow(search, _FOUND).withColumn("rank", F.row_number().over(order))
    return found.where(F.col("rank") <= settings.top).select("key", "rank", "_id", "score")


_RESULT = "item_id long, rank int, doc_id long, score long"


def searched(docs: DataFrame, items: DataFrame, settings: SearchSettings | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item, those with a score above 0.

    Terms are runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lowered.
    Missing texts and texts without a term are no documents. Repeated documents are ranked each;
    those without an id count, and come last among equals. Items without an id, a text or a term
    find nothing; equal items are one; items that share an id but not a text are ranked each. An
    empty table on either side gives no row; other columns are not looked at.
    """
    settings = settings or SearchSettings()
    spark = docs.sparkSession
    held = docs.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.col("text").alias("_text"))
    out = None
    for questions, ids in _asked(items, settings.block_words):
        found = _searched(materialise(_posted(held, questions.vocabulary)), questions, settings)
        # One row per question of the block, so its size is bounded by the block's.
        names = F.broadcast(spark.createDataFrame(list(ids.items()), "key int, item_id long"))
        doc_id = F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id")
        named = found.join(names, "key").select("item_id", F.col("rank").cast("int").alias("rank"), doc_id, "score")
        out = named if out is None else materialise(out.unionByName(named))
    return spark.createDataFrame([], _RESULT) if out is None else out
