"""Collocations, ranked search and nearest neighbours against brute force, on small tables with odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tillwarden.llm import collocations, hamming_index, queries, ranked_search
from tillwarden.llm.text import U64

DOCS = "doc_id long, text string, lang string, rank int, n long, words string"


def docs(spark, rows):
    """Rows (doc_id, text, lang) with columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, k, 1, 2, "x") for i, t, k in rows], DOCS)


# Collocations

def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def expected_phrases(rows, settings):
    f, whole = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            whole[lang or "und"] += len(w)
            for size in range(1, settings.longest + 1):
                f.update((lang or "und", *w[k : k + size]) for k in range(len(w) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= settings.least_count}
    around = Counter()
    for (lang, *w), a in candidates.items():
        for size in range(2, len(w)):
            for k in range(len(w) - size + 1):
                part = (lang, *w[k : k + size])
                around[part] = max(around[part], a)
    out = []
    for (lang, *w), a in candidates.items():
        n = whole[lang]
        cuts = [(1000 * a * n // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min(cuts)
        if 100 * around[lang, *w] < settings.cover_pct * a:
            out.append((lang, " ".join(w), a, left, right, n, score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    place, ranked = Counter(), []
    for r in out:
        place[r[0]] += 1
        if place[r[0]] <= settings.top:
            ranked.append((r[0], place[r[0]], *r[1:]))
    return ranked


def phrases(spark, rows, settings):
    got = collocations.mined(docs(spark, rows), settings)
    return sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["Ünder", "the", "THE", "sea", "élan", "a", "b c", "日本", "x", "end."]
    rows = [
        (k, " ".join(rng.choice(vocabulary, 40)) + "\tlow tide, high\x0btide low  tide", ["en", "es", None][k % 3]) for k in range(90)
    ]
    rows += [(1, "new york city hall", "en")] * 30 + [(None, "New\tYork; city hall", "en"), (7, None, "en"), (8, "", None), (9, " \t\n", "und")]
    for settings in (collocations.Collocations(least_count=20), collocations.Collocations(20, top=3), collocations.Collocations(5, cover_pct=60)):
        assert phrases(spark, rows, settings) == sorted(expected_phrases(rows, settings))


def test_a_very_long_text_and_a_very_frequent_phrase(spark):
    long = "so it goes " * 60_000
    rows = [(1, long, "en"), (2, "so it goes", "en"), *((k, "never ever", "de") for k in range(3000))]
    settings = collocations.Collocations(least_count=1000)
    got = phrases(spark, rows, settings)
    assert got == sorted(expected_phrases(rows, settings)) and ("de", 1, "never ever", 3000, 3000, 3000, 6000, 2000) in got


def test_products_beyond_64_bits(spark):
    """1000 * a * n / (l * r) with counts that no small table can have."""
    exact = [("en", 0, "", 10**15), ("en", 1, "a", 10**12), ("en", 1, "b", 10**9 + 7), ("en", 2, "a b", 10**9)]
    table = spark.createDataFrame(exact, "lang string, size int, phrase string, n long")
    counted, collocations.counts = collocations.counts, lambda docs, settings: table
    try:
        (row,) = collocations.mined(table).collect()
    finally:
        collocations.counts = counted
    assert row["score"] == 1000 * 10**9 * 10**15 // (10**12 * (10**9 + 7))


def test_no_documents_no_phrases(spark):
    assert phrases(spark, [], collocations.Collocations()) == [] == phrases(spark, [(1, None, None)], collocations.Collocations())


@pytest.mark.parametrize("capacity", [4, 64, 1000])
def test_summaries_never_lose_a_frequent_key(capacity):
    rng = np.random.default_rng(capacity)
    values = np.concatenate([rng.integers(0, 10**9, 20_000), np.repeat(np.arange(30), 120)]).astype(U64)
    rng.shuffle(values)
    merged = collocations.Summary(capacity, 100, 36)
    for part in np.array_split(values, 7):
        one = collocations.Summary(capacity, 100, 9)
        for some in np.array_split(part, 9):
            one.add(*np.unique(some, return_counts=True))
        merged.merge(one)
    found = merged.survivors()
    true = Counter(values.tolist())
    assert set(range(30)) <= set(found.tolist()) and merged.error < 100
    held = dict(zip(merged.keys.tolist(), merged.counts.tolist(), strict=True))
    assert all(n <= true[k] <= n + merged.error for k, n in held.items())
    lossy, other = collocations.Summary(4, 100), collocations.Summary(4, 100)
    for summary in (lossy, other):
        summary.add(np.arange(4000).astype(U64), np.full(4000, 60))
        summary.error = 60
    with pytest.raises(ValueError):
        lossy.merge(other)


def test_bitmap_holds_what_was_put(spark):
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, 50_000, dtype=U64)
    bitmap = collocations.Bitmap.empty(9)
    for region in range(512):
        bitmap.put(region, bitmap.slice(region, keys[keys >> U64(55) == region]))
    others = rng.integers(0, 2**64, 100_000, dtype=U64)
    assert bitmap.has(keys).all() and bitmap.has(others).mean() < 0.001


# Ranked search

def expected_ranks(rows, items, top):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    bags = [(i, Counter(split(t))) for i, t, _ in rows]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in sorted({(i, t) for i, t in items if i is not None and t is not None}):
        scores = []
        for i, bag in bags:
            m = 75 + 25 * bag.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * bag[w] // (1000 * bag[w] + 12 * m))
                for w in split(text)
                if w in bag
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def ranks(spark, rows, items, settings=None):
    questions = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, score int")
    got = ranked_search.searched(docs(spark, rows), questions, settings)
    return sorted((tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_ranks_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = ["Ab", "ab", "ÉTÉ", "été", "x1", "the", "the", "日本", "a-b", "q_r"]
    rows = [(k, " ".join(rng.choice(vocabulary, rng.integers(1, 30))), "en") for k in range(300)]
    rows += [(5, "ab the ab", "en")] * 40 + [(None, "ab the", None), (901, None, None), (902, "", "en"), (903, "-- ... !", "en"), (904, "日本 " * 30_000, "en")]
    items = [(1, "AB the the"), (2, "été; 日本?"), (3, "nothing here is known"), (4, ""), (None, "ab"), (5, None), (1, "AB the the"), (6, "x1")]
    expected = expected_ranks(rows, items, 20)
    assert ranks(spark, rows, items) == expected and {r[0] for r in expected} == {1, 2, 6}
    monkeypatch.setattr(ranked_search, "RUN_DOCS", 16)  # several runs of strata in a task
    assert ranks(spark, rows, items, ranked_search.SearchSettings(top=3)) == expected_ranks(rows, items, 3)


def test_questions_in_several_blocks(spark):
    rows = [(k, f"w{k} w{k % 3} common", "en") for k in range(50)]
    items = [(k, f"w{k} common words") for k in range(30)]
    assert ranks(spark, rows, items, ranked_search.SearchSettings(block_words=7)) == expected_ranks(rows, items, 20)


def test_nothing_to_search(spark):
    assert ranks(spark, [], [(1, "a")]) == [] == ranks(spark, [(1, "a", "en")], [])
    assert ranks(spark, [(1, None, "en")], [(1, "a")]) == []


def test_strata_bound_their_scores():
    rng = np.random.default_rng(2)
    document, term = (x.ravel() for x in np.meshgrid(np.arange(50), np.arange(20), indexing="ij"))
    held = rng.random(len(document)) < 0.3
    stratum = ranked_search.Stratum(90, np.arange(50), document[held], term[held], rng.integers(1, 9, held.sum()))
    asked, gain = np.array([1, 4, 7, 30]), np.array([500, 20, 4000, 9])
    assert 0 < stratum.scores(asked, gain).max() <= stratum.bound(asked, gain)


# Nearest neighbours

VECTORS = "vec_id long, embedding array<float>, score int, rank string"


def found(spark, rows, asked, settings=None):
    """{query: [(vec_id, distance)]}, nearest first."""
    vectors = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    got = hamming_index.neighbours(vectors, vectors.where(f"vec_id in ({asked})"), settings).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        own = out.setdefault(r["query_id"], [])
        own.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own)
    return out


def expected_near(rows, query, k=10):
    vectors = {}
    for i, v in rows:
        v = None if v is None or any(x is None for x in v) else np.array(v, np.float32).astype(float)
        if i is not None and v is not None and len(v) == 8 and np.isfinite(v).all() and v.any():
            vectors.setdefault(i, []).append(v)
    own = min(vectors[query], key=lambda v: v.tolist())
    far = {i: min(math.dist(v, own) for v in vs) for i, vs in vectors.items() if i != query}
    return sorted(far.items(), key=lambda x: (x[1], x[0]))[:k]


def test_neighbours_with_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(8).round(1).tolist()) for k in range(400)]
    rows += [(1000 + k, [0.5] * 8) for k in range(60)]  # more equal vectors than results
    rows += [(5, rows[5][1])] * 20 + [(6, [9.0] * 8)]
    bad = [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (2005, [None] * 8), (2006, [1.0]), (None, [1.0] * 8)]
    # A radius that reaches every code makes the search exact.
    exact = hamming_index.HammingSettings(covered=1.0, sample=1 << 20, rows=64)
    got = found(spark, rows + bad, "0, 3, 5, 6, 1000, 1059, 2002, 2006", exact)
    assert set(got) == {0, 3, 5, 6, 1000, 1059}
    for query, near in got.items():
        expected = expected_near(rows, query)
        assert [i for i, _ in near] == [i for i, _ in expected], query
        assert np.allclose([d for _, d in near], [d for _, d in expected], rtol=1e-14, atol=0)
    assert [i for i, _ in got[1059]] == list(range(1000, 1010))


def test_few_candidates_and_none(spark):
    three = [(k, [float(k), 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for k in range(1, 4)]
    assert [i for i, _ in found(spark, three, "2")[2]] == [1, 3]
    assert found(spark, [], "1") == {} == found(spark, three[:1], "1") == found(spark, [(1, None)], "1")


def test_questions_come_in_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(100)]
    whole = found(spark, rows, "1, 2, 3, 4, 5")
    assert found(spark, rows, "1, 2, 3, 4, 5", hamming_index.HammingSettings(block=2)) == whole


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 9, 20, 40])
def test_the_index_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    bits = rng.random((5000, 64)) < 0.5
    bits[: 2500] = bits[0] ^ (rng.random((2500, 64)) < 0.08)
    words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    parts = np.packbits(bits, axis=1, bitorder="little").view(np.uint16).astype(np.uint32)
    index = hamming_index.SubstringIndex(words, parts, 16)
    for k in (0, 3, 4000):
        assert index.within(words[k], parts[k], radius).tolist() == np.flatnonzero((bits ^ bits[k]).sum(axis=1) <= radius).tolist()


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toArrow()
    ids, vectors = table.column("vec_id").to_numpy(), np.array(table.column("embedding").to_pylist())
    got = {}
    for r in queries.op13_hamming_index(spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for query, near in got.items():
        own = vectors[np.flatnonzero(ids == query)[0]]
        far = hamming_index.distances(vectors, own)
        order = [k for k in np.lexsort((ids, far)).tolist() if ids[k] != query][:10]
        hits += len({int(ids[k]) for k in order} & set(near))
        assert len(near) == 10 and all(d == far[np.flatnonzero(ids == i)[0]] for i, d in near.items())
    assert hits >= 0.95 * 10 * len(got)
