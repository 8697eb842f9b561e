"""Finding benchmark items in documents.

Each item and each window of a document with as many words as the item has a weighted bag of
five-word shingles (a shingle weighs as often as it occurs). A 64-bit SimHash of the bag is
looked up in a multi-index: the fingerprint's blocks are listed with all values few bits away,
such that no fingerprint within the radius can be missed. What is found is then verified by
the exact weighted Jaccard similarity of the two bags.

Windows that share no shingle with any item have similarity 0 with all of them, so only
windows around shared shingles get a fingerprint. Items are broadcast in blocks of bounded
size, one pass over the documents for each block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.text import U64, Chunk, Prefix, byte_values, chunks, grams, inner, mix, unioned, words, wrapped
from tillwarden.session import materialise

SHINGLE = 5


@dataclass(frozen=True)
class Decontamination:
    """least_similarity: weighted Jaccard that makes a match. radius: Hamming distance within
    which the index finds every fingerprint (at the similarity of 0.8 the expected distance is
    about 10 of 64, so 23 lies more than four standard deviations above). block_words: most
    words of items that are broadcast at once."""

    least_similarity: float = 0.8
    radius: int = 23
    blocks: int = 8
    block_words: int = 2_000_000


def _folded(chunk: Chunk) -> Chunk:
    """The texts without case, in all alphabets (full case folding, so ß and SS are equal too).
    Folding gives or takes no separator, so words keep their places."""
    texts = map(chunk.bytes_of, range(len(chunk.offsets) - 1))
    folded = [
        t.lower() if t.isascii() else t.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
        for t in texts
    ]
    offsets = np.cumsum([0, *map(len, folded)], dtype=np.int64)
    return Chunk(chunk.batch, np.frombuffer(b"".join(folded), np.uint8), offsets)


def _word_hashes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without case, and each document's first."""
    folded = _folded(chunk)
    w = words(folded)
    return Prefix(byte_values(folded.data)).hash(w.start, w.end), w.first


def _signs(shingles: np.ndarray) -> np.ndarray:
    """64 signs of each shingle."""
    bits = np.unpackbits(mix(shingles).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """64 sums of signs -> 64 bits."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(U64).ravel()


class ItemIndex:
    """Items (id, word hashes) ready to be looked up."""

    def __init__(self, items: list[tuple[int, np.ndarray]], settings: Decontamination):
        self.settings = settings
        self.ids = np.array([i for i, _ in items], np.int64)
        self.sizes = np.array([len(h) for _, h in items], np.int64)
        #: An item of fewer words than a shingle is one shingle of its own size.
        self.bags = [Counter(grams(h, min(SHINGLE, len(h))).tolist()) for _, h in items]
        sums = np.array([_signs(np.array(list(b.elements()), U64)).sum(0) for b in self.bags]).reshape(len(items), 64)
        self.prints = _fingerprints(sums.astype(np.int32)) if len(items) else np.zeros(0, U64)
        self.held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in {int(min(SHINGLE, s)) for s in self.sizes}:
            pairs = sorted({(s, int(self.sizes[i])) for i, b in enumerate(self.bags) if min(SHINGLE, self.sizes[i]) == width for s in b})
            shingle, size = np.array([p[0] for p in pairs], U64), np.array([p[1] for p in pairs], np.int64)
            key, first = np.unique(shingle, return_index=True)
            self.held[width] = key, np.append(first, len(shingle)), size
        width = 64 // settings.blocks
        near = [sum(1 << b for b in flips) for n in range(settings.radius // settings.blocks + 1) for flips in combinations(range(width), n)]
        self.listed: list[dict[tuple[int, int], list[int]]] = [{} for _ in range(settings.blocks)]
        for i, value in enumerate(self.prints.tolist()):
            for b, listed in enumerate(self.listed):
                block = value >> b * width & (1 << width) - 1
                for flip in near:
                    listed.setdefault((int(self.sizes[i]), block ^ flip), []).append(i)
        self.width = width

    def candidates(self, size: int, value: int) -> set[int]:
        """Items of a size whose fingerprints are within the radius (and few others)."""
        found: set[int] = set()
        for b, listed in enumerate(self.listed):
            found.update(listed.get((size, value >> b * self.width & (1 << self.width) - 1), ()))
        return {i for i in found if (int(self.prints[i]) ^ value).bit_count() <= self.settings.radius}

    def windows(self, hashes: np.ndarray, first: np.ndarray):
        """(shingle width, shingles, document, first word, words, item size) of all windows that
        share a shingle with an item. A document shorter than the item is one window."""
        document = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for width, (keys, cuts, sizes) in self.held.items():
            shingles = grams(hashes, width)
            if not len(shingles):
                continue
            at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
            place = np.flatnonzero((keys[at] == shingles) & inner(first, width))
            if not len(place):
                continue
            lists = at[place]
            times = cuts[lists + 1] - cuts[lists]
            step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
            size = sizes[np.repeat(cuts[lists], times) + step]
            place = np.repeat(place, times)
            owner = document[place]
            begin, end = first[owner], first[owner + 1]
            low = np.maximum(begin, place - size + width)
            high = np.maximum(low, np.minimum(place, end - size))
            low = np.minimum(low, np.maximum(begin, end - size))
            # Neighbouring shingles ask for almost the same windows: ranges are merged before they are listed.
            size, low, end = unioned(size, low, high + 1)
            spread = end - low
            step = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread)
            start, size = np.repeat(low, spread) + step, np.repeat(size, spread)
            owner = document[start]
            yield width, shingles, owner, start, np.minimum(size, first[owner + 1] - start), size

    def matches(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(document, item index, first word in the document, words, similarity), best window only."""
        best: dict[tuple[int, int], tuple[float, int, int]] = {}  # similarity, minus the place, words
        for width, shingles, owner, start, n, size in self.windows(hashes, first):
            order = np.argsort(start, kind="stable")
            for part in _stretches(start[order]):
                own = order[part]
                self._matched(best, shingles, width, first, owner[own], start[own], n[own], size[own])
        return [(d, i, -place, m, similarity) for (d, i), (similarity, place, m) in sorted(best.items())]

    def _matched(self, best, shingles, width, first, owner, start, n, size) -> None:
        """Put the windows of one stretch that match into ``best``."""
        begin = int(start[0])
        stretch = shingles[begin : int((start + n).max()) - width + 1]
        sums = np.zeros((len(stretch) + 1, 64), np.int32)
        np.cumsum(_signs(stretch), axis=0, out=sums[1:])
        row = start - begin
        prints = _fingerprints(sums[row + n - width + 1] - sums[row])
        for d, s, m, whole, value in zip(owner.tolist(), start.tolist(), n.tolist(), size.tolist(), prints.tolist(), strict=True):
            near = self.candidates(whole, value)
            if not near:
                continue
            bag = Counter(shingles[s : s + m - width + 1].tolist())
            for i in near:
                both = (bag & self.bags[i]).total()
                similarity = both / (bag.total() + self.bags[i].total() - both)
                if similarity >= self.settings.least_similarity:
                    best[d, i] = max(best.get((d, i), (-1.0, 0, 0)), (similarity, int(first[d]) - s, m))


def _stretches(start: np.ndarray, most: int = 1 << 15) -> Iterator[slice]:
    """Windows by rising start, cut into parts that span about ``most`` shingles each (a single
    window may be longer, as long as its item), so that a text of any length takes bounded memory."""
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + most, "left")))
        yield slice(a, b)
        a = b


def _blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items in blocks of at most ``block_words`` words (or one item). Items without an id or a
    word match nothing. Rows come to the driver one partition at a time; of what it has read it
    holds one block, as word hashes."""
    rows = items.select(F.col("item_id").cast("long"), "text").filter("item_id IS NOT NULL AND text IS NOT NULL")
    block: list[tuple[int, np.ndarray]] = []
    held = 0
    for row in rows.toLocalIterator():
        data = np.frombuffer(row["text"].encode(), np.uint8)
        hashes, _ = _word_hashes(Chunk(None, data, np.array([0, len(data)])))
        if not len(hashes):
            continue
        if held and held + len(hashes) > block_words:
            yield block
            block, held = [], 0
        block.append((row["item_id"], hashes))
        held += len(hashes)
    yield block


_KIND = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())]))
_HITS = "array<struct<item_id:bigint,start:int,n_words:int,similarity:double>>"


def _with_hits(rows: DataFrame, block: list[tuple[int, np.ndarray]], settings: Decontamination, text: str) -> DataFrame:
    """rows with the hits of one block appended to the column hits."""
    names = rows.columns
    sent = rows.sparkSession.sparkContext.broadcast((block, settings))

    def match(batches):
        index = ItemIndex(*sent.value)
        for chunk in chunks(batches, text):
            found = chunk.batch.column("hits").to_pylist()
            for d, i, place, n, similarity in index.matches(*_word_hashes(chunk)):
                found[d].append({"item_id": int(index.ids[i]), "start": place, "n_words": n, "similarity": similarity})
            columns = [pa.array(found, _KIND) if c == "hits" else chunk.batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(match, rows.schema)


def matched(docs: DataFrame, items: DataFrame, settings: Decontamination | None = None) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``) and ``hits``: an array with one struct
    (item_id, start, n_words, similarity) per item that a window of the text matches (the best
    window, the first of equal ones; start counts words). Missing and empty texts, and an empty
    ``items``, have no hits; repeated rows are judged each, repeated items give a hit each."""
    settings = settings or Decontamination()
    rows = wrapped(docs).withColumn("hits", F.array().cast(_HITS))
    for k, block in enumerate(_blocks(items, settings.block_words)):
        rows = _with_hits(rows if k == 0 else materialise(rows), block, settings, "row.text")
    return rows


def judged(docs: DataFrame, items: DataFrame, settings: Decontamination | None = None) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (ascending), best_similarity (0 without a hit)."""
    rows = matched(docs.select(F.col("doc_id").cast("long"), "text"), items, settings)
    best = F.coalesce(F.array_max("hits.similarity"), F.lit(0.0)).alias("best_similarity")
    ids = F.array_sort(F.array_distinct("hits.item_id"))
    return rows.select(
        F.col("row.doc_id"), (F.size("hits") > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), best
    )


def clean(docs: DataFrame, items: DataFrame, settings: Decontamination | None = None) -> DataFrame:
    """The rows of ``docs`` that match no item, unchanged."""
    return matched(docs, items, settings).filter(F.size("hits") == 0).select("row.*")
