"""Sampled segmentations with the pieces of a SentencePiece model, and their lossless decoding.

All ways to write a text as pieces form a lattice. Forward filtering sums, for every position,
the weight of all paths that reach it; backward sampling walks from the end and takes each piece
in proportion to the weight that arrives through it, so whole segmentations are drawn by their
probability. Random numbers are a hash of the row's key and the position, so a document's
segmentation does not depend on partitions, order or reruns.

No piece has a space after another character, some characters are in no piece at all, and most
pairs of characters stand in none (nearly all of them in writing without spaces). Texts fall into
units there, which the lattice need not cross. Equal units of a chunk share one lattice; the walks
of all their occurrences run side by side in numpy. What is left of a very long unit (a run of
letters without a space) is filtered and walked one by one, at about the same cost a byte.

Spaces of the text are the model's word mark; the mark itself, and every character without a
piece, is spelled in byte pieces, so decoding gives back every text exactly.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.text import U64, Prefix, byte_values, chunks, mix

CHUNK = 1 << 20
MARK = "▁"
#: Bytes of a unit that are filtered side by side with others, and walks that go one by one.
LEVELS = 256
FEW_WALKS = 8


class Pieces:
    """The lattice's pieces: a trie over bytes and log weights.

    A merge model ranks its pieces but gives no probabilities; a piece of rank r weighs
    1 / (1 + r), as frequencies by rank do. Pieces without a rank and bytes come last.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.spelled: list[bytes] = [b""] * n
        self.weight = np.zeros(n)
        self.byte_piece = np.full(256, -1)
        regular = []
        for i in range(n):
            if sp.is_byte(i):
                value = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_piece[value], self.spelled[i] = i, bytes([value])
                self.weight[i] = -np.log1p(n)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.spelled[i] = sp.id_to_piece(i).replace(MARK, " ").encode()
                rank = -sp.get_score(i)
                self.weight[i] = -np.log1p(rank if 0 <= rank < n else n)
                regular.append(i)
        if (self.byte_piece < 0).any():
            raise ValueError(f"{path} has no byte pieces, so some texts have no spelling")
        self.single = {s.decode() for i in regular if len((s := self.spelled[i]).decode()) == 1}
        held = {b for i in regular for b in self.spelled[i]}
        pairs = {(a, b) for i in regular for a, b in itertools.pairwise(self.spelled[i].decode())}
        self.pairs = np.sort(np.array([ord(a) << 21 | ord(b) for a, b in pairs], np.int64))
        self.alone = np.array([b < 0x80 and b not in held for b in range(256)])
        if any(b" " in self.spelled[i].lstrip(b" ") for i in regular):
            raise ValueError(f"{path} has pieces with an inner space")
        states: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in regular:
            state = 0
            for b in self.spelled[i]:
                state = states.setdefault((state, b), len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = i
        self.ends = np.array(ends)
        keys = np.array([s * 256 + b for s, b in states])
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], np.array(list(states.values()))[order]
        self.root = np.full(256, -1)
        for (s, b), t in states.items():
            if s == 0:
                self.root[b] = t

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states, -1 where the trie has none."""
        key = state * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)

    def separate(self, data: np.ndarray) -> np.ndarray:
        """Which characters begin where no piece can reach over from the one before."""
        first = np.flatnonzero((data & 0xC0) != 0x80)
        lead = data[first].astype(np.int64)
        width = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        point = np.where(width == 1, lead, lead & (0x7F >> width))
        for k in range(1, 4):
            more = width > k
            point[more] = point[more] << 6 | data[first[more] + k] & 0x3F
        pair = point[:-1] << 21 | point[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        out = np.zeros(len(data), bool)
        out[first[1:][self.pairs[at] != pair]] = True
        return out

    def unknown_bytes(self, data: np.ndarray) -> np.ndarray:
        """Bytes of characters that are no piece."""
        out = np.zeros(len(data), bool)
        ascii_known = np.array([chr(b) in self.single for b in range(128)] + [True] * 128)
        out |= ~ascii_known[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            width = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
            code = np.zeros(len(lead), np.int64)
            for k in range(4):
                more = width > k
                code[more] = code[more] << 8 | data[lead[more] + k]
            for value in np.unique(code):
                size = (int(value).bit_length() + 7) // 8
                if int(value).to_bytes(size, "big").decode() not in self.single:
                    hit = lead[code == value]
                    for k in range(size):
                        out[hit + k] = True
        return out


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """Forward-filtered lattices of units: data[start[i]:end[i]] is unit i.

    Unit i has end[i] - start[i] + 1 nodes from ``node[i]`` on. Arcs are stored by the node that
    they enter; ``chance`` adds up the probabilities of the arcs into a node.
    """

    def __init__(self, p: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray, alpha: float):
        size = end - start
        self.node = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        total = int((size + 1).sum())
        place = np.arange(int(size.sum()))
        unit = np.repeat(np.arange(len(size)), size)
        offset = place - np.repeat(np.cumsum(size) - size, size)
        data = data[start[unit] + offset]
        left = size[unit] - offset

        froms, widths, ids = [], [], []
        live, state, depth = place, p.root[data], 1
        while len(live):
            good = state >= 0
            live, state = live[good], state[good]
            full = p.ends[state] >= 0
            froms.append(live[full])
            ids.append(p.ends[state[full]])
            widths.append(np.full(int(full.sum()), depth))
            good = left[live] > depth
            live, state = live[good], state[good]
            state = p.step(state, data[live + depth])
            depth += 1
        bare = np.flatnonzero(p.unknown_bytes(data))
        froms.append(bare)
        ids.append(p.byte_piece[data[bare]])
        widths.append(np.ones(len(bare), np.int64))
        start_of, width, piece = (np.concatenate(x) for x in (froms, widths, ids))

        into_level = offset[start_of] + width
        source = self.node[unit[start_of]] + offset[start_of]
        order = np.argsort(into_level << 32 | source + width, kind="stable")
        self.source, self.width, self.piece = source[order], width[order], piece[order]
        level, target = into_level[order], (source + width)[order]
        weight = p.weight[self.piece] * alpha
        reach = np.full(total, -np.inf)
        reach[self.node] = 0.0
        self.first, self.count = np.zeros(total, np.int64), np.zeros(total, np.int64)
        chance = np.zeros(len(order))
        top = int(level[-1]) if len(level) else 0
        cuts = np.searchsorted(level, np.arange(1, min(top, LEVELS) + 2))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            entered = target[a:b]
            head = np.flatnonzero(np.concatenate([[True], entered[1:] != entered[:-1]]))
            count = np.diff(np.append(head, b - a))
            value = reach[self.source[a:b]] + weight[a:b]
            most = np.maximum.reduceat(value, head)
            most = np.where(np.isfinite(most), most, 0.0)
            scaled = np.exp(value - np.repeat(most, count))
            sums = np.add.reduceat(scaled, head)
            with np.errstate(divide="ignore", invalid="ignore"):
                reach[entered[head]] = np.log(sums) + most
                running = np.cumsum(scaled)
                before = np.repeat(running[head] - scaled[head], count)
                chance[a:b] = (running - before) / np.repeat(sums, count)
            self.first[entered[head]], self.count[entered[head]] = a + head, count
        self.chance, self.reach = chance, reach
        if top > LEVELS:
            self._rest(int(cuts[-1]), target, weight)

    def _rest(self, a: int, target: np.ndarray, weight: np.ndarray) -> None:
        """The levels beyond LEVELS, arc by arc."""
        reached: dict[int, float] = {}
        arcs = zip(target[a:].tolist(), self.source[a:].tolist(), weight[a:].tolist(), strict=True)
        for node, group in itertools.groupby(arcs, key=lambda x: x[0]):
            values = []
            for _, source, own in group:
                before = reached.get(source)
                values.append((float(self.reach[source]) if before is None else before) + own)
            most = max(values)
            most = most if math.isfinite(most) else 0.0
            scaled = [math.exp(v - most) for v in values]
            total = sum(scaled)
            if total > 0:
                self.chance[a : a + len(values)] = [x / total for x in itertools.accumulate(scaled)]
                reached[node] = math.log(total) + most
            else:
                reached[node] = -math.inf
            self.first[node], self.count[node] = a, len(values)
            a += len(values)


def _units(p: Pieces, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at documents, at the first of some spaces, around bytes in no piece, and
    between characters that no piece holds side by side."""
    space, alone = data == 0x20, p.alone[data]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins |= alone | p.separate(data) & ~space
    begins[1:] |= alone[:-1]
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def sampled(p: Pieces, chunk, seeds: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a chunk's texts and where each text's begin (and the end)."""
    n = len(chunk.offsets) - 1
    full = np.diff(chunk.offsets) > 0
    offsets = chunk.offsets + np.concatenate([[0], np.cumsum(full)])
    data = np.full(len(chunk.data) + int(full.sum()), 0x20, np.uint8)
    inside = np.ones(len(data), bool)
    inside[offsets[:-1][full]] = False
    data[inside] = chunk.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    start = _units(p, data, offsets)
    end = np.append(start[1:], len(data))
    _, where, which = np.unique(Prefix(byte_values(data)).hash(start, end), return_index=True, return_inverse=True)
    lattice = Lattice(p, data, start[where], end[where], alpha)

    document = np.searchsorted(offsets, start, "right") - 1
    base = mix(seeds.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1))[document]
    walk = np.arange(len(start))
    node, root, at = lattice.node[which] + (end - start), lattice.node[which], end - offsets[document]
    steps, taken = [], []
    while len(walk) > FEW_WALKS or len(walk) and len(steps) < LEVELS:
        u = (mix(base[walk] ^ mix(at[walk].astype(U64))) >> U64(11)).astype(np.float64) * 2.0**-53
        arc, left = lattice.first[node[walk]].copy(), lattice.count[node[walk]] - 1
        open_ = np.flatnonzero((lattice.chance[arc] <= u) & (left > 0))
        while len(open_):
            arc[open_] += 1
            left[open_] -= 1
            open_ = open_[(lattice.chance[arc[open_]] <= u[open_]) & (left[open_] > 0)]
        steps.append(walk)
        taken.append(lattice.piece[arc])
        node[walk] = lattice.source[arc]
        at[walk] -= lattice.width[arc]
        walk = walk[node[walk] > root[walk]]
    alone = {w: _walked(lattice, int(base[w]), int(node[w]), int(root[w]), int(at[w])) for w in walk.tolist()}
    counts = np.bincount(np.concatenate(steps), minlength=len(start))
    for w, found in alone.items():
        counts[w] += len(found)
    stop = np.cumsum(counts)
    ids = np.zeros(int(stop[-1]), np.int64)
    for w, found in alone.items():
        ids[stop[w] - counts[w] : stop[w] - counts[w] + len(found)] = found[::-1]
    for k, (who, piece) in enumerate(zip(steps, taken, strict=True)):
        ids[stop[who] - 1 - k] = piece
    return ids, np.concatenate([[0], stop])[np.searchsorted(start, offsets)]


_ALL = (1 << 64) - 1


def _mixed(x: int) -> int:
    """``mix`` of one number."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _ALL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def _walked(lattice: Lattice, base: int, node: int, root: int, at: int) -> list[int]:
    """The pieces that one walk takes from ``node`` down to ``root``, last piece first."""
    taken = []
    while node > root:
        u = (_mixed(base ^ _mixed(at)) >> 11) * 2.0**-53
        arc, left = int(lattice.first[node]), int(lattice.count[node]) - 1
        while left > 0 and lattice.chance[arc] <= u:
            arc += 1
            left -= 1
        taken.append(int(lattice.piece[arc]))
        node = int(lattice.source[arc])
        at -= int(lattice.width[arc])
    return taken


def decoded(p: Pieces, ids: list[int]) -> bytes:
    """The text's bytes: all pieces joined, without the space put before every text."""
    return b"".join([p.spelled[i] for i in ids])[1:]


def encode(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids (array) and the columns ``keep`` of every row. ``alpha`` below 1 flattens the
    distribution. The key is doc_id: rows that share an id and a text get equal ids. Missing and
    empty texts have no ids; a missing id is one key."""

    def run(batches):
        p = pieces(model)
        for chunk in chunks(batches, size=CHUNK):
            seeds = mix(chunk.column("doc_id").astype(U64) + U64(seed))
            ids, cuts = sampled(p, chunk, seeds, alpha)
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))
            kept = [chunk.batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*kept, lists], ["doc_id", *keep, "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", *[c for c in keep if c != "text"])
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"doc_id long, {kept + ', ' if keep else ''}ids array<int>")


def decode(rows: DataFrame, model: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text from doc_id, ids; text is '' for no ids."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            lists = batch.column("ids").fill_null([])
            texts = [decoded(p, x).decode() for x in lists.to_pylist()]
            kept = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], ["doc_id", *keep, "text"])

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select("doc_id", *keep, "ids").mapInArrow(run, f"doc_id long, {kept + ', ' if keep else ''}text string")


def checked(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, lossless: each text is encoded, decoded again and compared
    in one pass; the crc32 is over the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        import zlib

        p = pieces(model)
        for chunk in chunks(batches, size=CHUNK):
            seeds = mix(chunk.column("doc_id").astype(U64) + U64(seed))
            ids, cuts = sampled(p, chunk, seeds, alpha)
            raw, plain = ids.astype("<u4"), ids.tolist()
            crc, same = [], []
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                crc.append(zlib.crc32(raw[a:b].tobytes()))
                same.append(decoded(p, plain[a:b]) == chunk.bytes_of(i))
            yield pa.RecordBatch.from_arrays(
                [chunk.batch.column("doc_id"), pa.array(np.diff(cuts)), pa.array(crc, pa.int64()), pa.array(same)],
                ["doc_id", "n_tokens", "ids_crc32", "lossless"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, lossless boolean")
