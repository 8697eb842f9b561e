"""Phrases whose words go together more often than their parts would, per language.

Three passes over the texts, none of which holds all n-grams anywhere:

1. Words and word pairs are counted by 64-bit hash into Misra-Gries summaries, one per hash
   region. A summary has more counters than its region's mass divided by the least count, so
   whatever occurs that often survives.
2. The same for longer phrases, of which only those are looked at whose word pairs have all
   survived: a phrase is no more frequent than its parts.
3. What survives is counted exactly, by its text.

Between the passes survivors go to the tasks as a bitmap of fixed size, whatever the corpus: each
region owns a slice of it. A fuller bitmap lets more phrases through to be counted, it never
loses one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.llm.bitmaps import Bitmap, region_of
from tillwarden.llm.text import SEPARATOR, U64, Chunk, chunks, grams, lowered, mix, words
from tillwarden.session import materialise

#: Bytes that end a piece (.,;:!? and line ends); words are split at blanks and tabs too.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK | SEPARATOR
NO_LANGUAGE = "und"
#: Keys that a task sorts at once (16 MB), and phrases whose counts it keeps before it sends them.
BATCH_KEYS = 1 << 21
BATCH_PHRASES = 200_000
#: Parts into which the phrases of a language are dealt.
PARTS = 64


@dataclass(frozen=True)
class Collocations:
    """least_count: occurrences that make a candidate. longest: most words of one. cover_pct: a
    candidate goes if a longer one around it has this share of its occurrences. top: phrases kept
    per language. counters: of one summary, as long as there are regions to be had."""

    least_count: int = 100
    longest: int = 5
    cover_pct: int = 100
    top: int = 2000
    counters: int = 1 << 17


class Phrases:
    """The words of a chunk with the keys of all runs of words that stay inside one piece."""

    def __init__(self, chunk: Chunk):
        self.chunk = lowered(chunk)
        self.words = words(self.chunk, GAP)
        document = np.repeat(np.arange(len(chunk.offsets) - 1), self.words.counts)
        self.piece = np.cumsum(BREAK[self.chunk.data])[self.words.start] + document
        languages = chunk.batch.column("_lang").dictionary_encode()
        self.languages = languages.dictionary.to_pylist()
        self.of_document = languages.indices.to_numpy(zero_copy_only=False)
        self.language = self.of_document[document]
        digests = [hashlib.blake2b(name.encode(), digest_size=8).digest() for name in self.languages]
        self.salt = np.frombuffer(b"".join(digests), U64)

    def keys(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """A key per language and run of ``size`` words, for every start, and whether it is inside
        one piece."""
        hashed = grams(self.words.hashes, size)
        n = len(hashed)
        return mix(hashed ^ self.salt[self.language[:n]]), self.piece[:n] == self.piece[size - 1 :][:n]

    def text(self, first: int, size: int) -> str:
        w = self.words
        parts = (self.chunk.data[w.start[k] : w.end[k]].tobytes() for k in range(first, first + size))
        return b" ".join(parts).decode()


class Summary:
    """Misra-Gries counts of keys. Every count is at most ``error`` too low and never too high.

    A summary drops at most ``allowed`` of any count (less than ``least``): if it can't make room
    within that it is given more, so nothing that occurs ``least`` times is ever lost. Summaries
    that are to be merged share what is allowed.
    """

    def __init__(self, capacity: int, least: int, allowed: int | None = None):
        self.capacity, self.least, self.error, self.dropped = capacity, least, 0, 0
        self.allowed = least - 1 if allowed is None else allowed
        self.keys, self.counts = np.zeros(0, U64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        if sum(len(k) for k, _ in self._waiting) >= self.capacity:
            self._fold()

    def merge(self, other: Summary) -> None:
        """The errors of two summaries add up."""
        other._fold()
        if self.error + other.error >= self.least:
            raise ValueError("these summaries have dropped too much to be merged")
        self.error += other.error
        self.add(other.keys, other.counts)

    def _fold(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self._waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self._waiting)])
        self._waiting = []
        self.keys, self.counts = summed(keys, counts)
        extra = len(self.keys) - self.capacity
        if extra <= 0:
            return
        cut = int(np.partition(self.counts, extra - 1)[extra - 1])
        if self.dropped + cut > self.allowed:
            self.capacity = 2 * len(self.keys)
            return
        kept = self.counts > cut
        self.keys, self.counts = self.keys[kept], self.counts[kept] - cut
        self.dropped += cut
        self.error += cut

    def survivors(self) -> np.ndarray:
        """All keys that may occur ``least`` times."""
        self._fold()
        return self.keys[self.counts + self.error >= self.least]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.add.reduceat(counts, head)


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each is there. Sorts in place."""
    keys.sort()
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], np.diff(np.append(head, len(keys)))


def _joined_pairs(phrases: Phrases, size: int, pairs: np.ndarray) -> np.ndarray:
    """Runs of ``size`` words all of whose word pairs are marked in ``pairs``."""
    n = max(0, len(phrases.piece) - size + 1)
    return np.logical_and.reduce([pairs[k : k + n] for k in range(size - 1)])


def _marked(phrases: Phrases, size: int, known: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    keys, whole = phrases.keys(size)
    return keys, whole & known.has(keys)


def _survivors(docs: DataFrame, sizes: range, mass: int, settings: Collocations, known: Bitmap | None) -> Bitmap:
    """A bitmap of all runs with a number of words in ``sizes`` that may be frequent enough.
    ``mass`` bounds how many there are. With ``known``, only runs whose word pairs are in it count."""
    spark = docs.sparkSession
    wanted = 2 * mass // (settings.least_count * settings.counters)
    bits = min(16, max(8, wanted.bit_length()))
    capacity = max(1024, 2 * mass // (settings.least_count << bits))
    sent = None if known is None else spark.sparkContext.broadcast((known.region_bits, known.bits))

    def pack(keys: np.ndarray) -> pa.RecordBatch:
        keys, counts = tallied(keys)
        counts = counts.astype(np.uint32)
        regions = region_of(keys, bits)
        cuts = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1]]))
        blobs = [
            keys[a:b].tobytes() + counts[a:b].tobytes()
            for a, b in zip(cuts, np.append(cuts[1:], len(keys)), strict=True)
        ]
        return pa.RecordBatch.from_arrays([pa.array(regions[cuts], pa.int32()), pa.array(blobs, pa.binary())], ["region", "packed"])

    def gather(batches):
        before = None if sent is None else Bitmap(*sent.value)
        held: list[np.ndarray] = []
        for chunk in chunks(batches, "_text"):
            phrases = Phrases(chunk)
            pairs = None if before is None else _marked(phrases, 2, before)[1]
            for size in sizes:
                keys, ok = phrases.keys(size)
                if pairs is not None:
                    ok = ok & _joined_pairs(phrases, size, pairs)
                held.append(keys[ok])
            if sum(map(len, held)) >= BATCH_KEYS:
                yield pack(np.concatenate(held))
                held = []
        if any(map(len, held)):
            yield pack(np.concatenate(held))

    def reduce(batches):
        at, summary = None, None
        empty = Bitmap(bits, np.zeros(0, np.uint8))

        def ended():
            content = empty.slice(at, summary.survivors())
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([content], pa.binary())], ["region", "slice"])

        for batch in batches:
            for region, packed in zip(batch.column("region").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                if region != at:
                    if summary is not None:
                        yield ended()
                    at, summary = region, Summary(capacity, settings.least_count)
                n = len(packed) // 12
                summary.add(np.frombuffer(packed, U64, n), np.frombuffer(packed, np.uint32, n, 8 * n).astype(np.int64))
        if summary is not None:
            yield ended()

    tasks = min(1 << bits, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.mapInArrow(gather, "region int, packed binary").repartition(tasks, "region").sortWithinPartitions("region")
    found = Bitmap.empty(bits)
    # One slice per region: 16 MB in all, whatever the corpus.
    for row in dealt.mapInArrow(reduce, "region int, slice binary").collect():
        found.put(row["region"], row["slice"])
    return found


_COUNTED = "lang string, size int, phrase string, n long"
_COUNT_COLUMNS = ("lang", "size", "phrase", "n")
#: Regions of phrases, by hash; the phrases of a region are sent and counted together.
PHRASE_REGIONS = 1024


def _sent_phrases(held: dict[int, list]) -> pa.RecordBatch:
    """The counts so far, one row of lists per region."""
    keys = np.fromiter(held, U64, len(held))
    regions = (keys >> U64(32)).astype(np.int64) % PHRASE_REGIONS
    order = np.argsort(regions, kind="stable")
    values, regions = list(held.values()), regions[order]
    cuts = np.flatnonzero(np.concatenate([[True], regions[1:] != regions[:-1]]))
    offsets = pa.array(np.append(cuts, len(order)).astype(np.int32))
    types = (pa.string(), pa.int32(), pa.string(), pa.int64())
    lists = [pa.ListArray.from_arrays(offsets, pa.array([values[i][k] for i in order.tolist()], t)) for k, t in enumerate(types)]
    return pa.RecordBatch.from_arrays([pa.array(regions[cuts], pa.int32()), *lists], ["region", *_COUNT_COLUMNS])


def _phrases_of_regions(least: int):
    """Sums of the counts of each region (rows come sorted by region), those of ``least`` and more."""

    def total(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by(list(_COUNT_COLUMNS[:3])).aggregate([("n", "sum")]).rename_columns(_COUNT_COLUMNS)

    def count(batches):
        at, held = None, []

        def ended():
            whole = total(held)
            kept = pc.or_(pc.greater_equal(whole["n"], least), pc.equal(whole["size"], 0))
            return whole.filter(kept).combine_chunks().to_batches()

        for batch in batches:
            regions = batch.column("region").to_numpy()
            for a in range(batch.num_rows):
                if regions[a] != at:
                    if held:
                        yield from ended()
                    at, held = regions[a], []
                row = batch.slice(a, 1)
                held.append(pa.table([row.column(c).flatten() for c in _COUNT_COLUMNS], list(_COUNT_COLUMNS)))
                if len(held) >= 64:
                    held = [total(held)]
        if held:
            yield from ended()

    return count


def _exact(docs: DataFrame, pairs: Bitmap, longer: Bitmap, settings: Collocations) -> DataFrame:
    """lang, size, phrase, n of what the bitmaps let through, and all words of a language as the
    phrase of size 0."""
    sent = docs.sparkSession.sparkContext.broadcast([(m.region_bits, m.bits) for m in (pairs, longer)])

    def count(batches):
        short, long = (Bitmap(*x) for x in sent.value)
        held: dict[int, list] = {}
        for chunk in chunks(batches, "_text", 2 << 20):
            phrases = Phrases(chunk)
            in_all = np.bincount(phrases.language, minlength=len(phrases.languages))
            for name, salt, n in zip(phrases.languages, phrases.salt.tolist(), in_all.tolist(), strict=True):
                held.setdefault(salt, [name, 0, "", 0])[3] += n
            marks = None
            for size in range(1, settings.longest + 1):
                keys, ok = phrases.keys(size)
                if size > 2:
                    ok = ok & _joined_pairs(phrases, size, marks)
                at = np.flatnonzero(ok)
                at = at[(short if size < 3 else long).has(keys[at])]
                if size == 2:
                    marks = np.zeros(len(ok), bool)
                    marks[at] = True
                found, place, n = np.unique(keys[at], return_index=True, return_counts=True)
                for key, first, times in zip(found.tolist(), at[place].tolist(), n.tolist(), strict=True):
                    entry = held.get(key)
                    if entry is None:
                        held[key] = [phrases.languages[phrases.language[first]], size, phrases.text(first, size), times]
                    else:
                        entry[3] += times
            if len(held) > BATCH_PHRASES:
                yield _sent_phrases(held)
                held = {}
        if held:
            yield _sent_phrases(held)

    sent_as = "region int, lang array<string>, size array<int>, phrase array<string>, n array<long>"
    tasks = min(PHRASE_REGIONS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = docs.mapInArrow(count, sent_as).repartition(tasks, "region").sortWithinPartitions("region")
    return dealt.mapInArrow(_phrases_of_regions(settings.least_count), _COUNTED)


def counts(docs: DataFrame, settings: Collocations | None = None) -> DataFrame:
    """lang, size, phrase, n: exact occurrences of every phrase of 1 to ``longest`` words that has
    at least ``least_count`` of them in its language; size 0 and an empty phrase: all words of the
    language."""
    settings = settings or Collocations()
    held = docs.select(F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("_lang"), F.coalesce("text", F.lit("")).alias("_text"))
    # A word and what ends it take two bytes at least, so there are no more words than this.
    most_words = held.agg(F.sum((F.octet_length("_text") + 1) / 2).cast("long")).first()[0] or 0
    pairs = _survivors(held, range(1, 3), 2 * most_words, settings, None)
    longer = _survivors(held, range(3, settings.longest + 1), (settings.longest - 2) * most_words, settings, pairs)
    return _exact(held, pairs, longer, settings)


def _part(first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def mined(docs: DataFrame, settings: Collocations | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    a counts the phrase, l and r the parts of its weakest cut, n all words of the language; the
    score is 1000 * a * n / (l * r), rounded down, in decimals that hold any product. Texts and
    languages that are missing count as empty and as ``und``; repeated rows count each; an empty
    table gives no row; other columns are not looked at.
    """
    settings = settings or Collocations()
    exact = materialise(counts(docs, settings))
    # A language may hold most phrases, so they meet its total in parts.
    part_of = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).cast("int").alias("_part")
    totals = exact.where("size = 0").select("lang", F.col("n").alias("all_words"))
    whole = totals.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    parts = exact.where("size > 0").select("lang", "phrase", "n")
    candidates = exact.where("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size", F.split("phrase", " ").alias("words"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": _part(1, F.col("k")), "rest": _part(F.col("k") + 1, F.col("size") - F.col("k"))})
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    scored = scored.withColumn("_part", part_of).join(whole, ["lang", "_part"])
    product = F.expr("CAST(1000 AS DECIMAL(4,0)) * (CAST(a AS DECIMAL(16,0)) * CAST(all_words AS DECIMAL(16,0)))")
    score = F.expr("product div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    weakest = (
        scored.withColumn("product", product)
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", F.col("all_words").alias("n"))).alias("cut"))
        .select("lang", "phrase", "cut.*")
    )

    # Every shorter run of two words or more inside a candidate, with the candidate's count.
    sizes = F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("inner")
    runs = candidates.where("size > 2").select("lang", "a", "size", "words", sizes)
    starts = F.explode(F.sequence(F.lit(1), F.col("size") - F.col("inner") + 1)).alias("start")
    runs = runs.select("lang", "a", "words", "inner", starts).select("lang", "a", _part(F.col("start"), F.col("inner")).alias("phrase"))
    around = runs.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = weakest.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (100 * F.col("around") < settings.cover_pct * F.col("a"))
    )

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # And each part is cut to the top before they meet.
    part = Window.partitionBy("lang", "_part").orderBy(*order)
    best = kept.withColumn("_part", part_of).withColumn("rank", F.row_number().over(part))
    best = best.where(F.col("rank") <= settings.top).drop("_part")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= settings.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
