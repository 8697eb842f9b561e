"""Every operator against brute force over a table with hard cases, and over an empty one."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillwarden.llm import (
    automata, decontaminate, host_rules, jaccard_join, language, piece_sampling, quality_fm, suffix_levels, token_files,
    token_lengths,
)

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `_id` string, row int, host int, hits int, `class` int, label int, start int"
ITEM = "these are the exact words that a benchmark item is made of and no other text should hold them"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage, long_one = prose(120), prose(70), prose(6000)
    near = base.split(" ")
    texts = [base, base, " ".join(near[:-1] + ["other"]), " ".join(["new", *near[1:]]), passage + " " + prose(60)]
    texts += [prose(30) + " " + passage + " " + prose(20), passage, long_one, prose(40) + " " + long_one[5000:6000]]
    texts += ["", " ", "\n\n", "one", "two words", "Two Words", "x" * 900, "y" * 900 + "x" * 500, "ab" * 700, "zero\u0000byte " * 60]
    texts += ["line\nline\n line\nline", "#### $$$$ | <>", f"{prose(30)} {ITEM} {prose(9)}", ITEM.upper(), ITEM[:-5], "▁ a▁b  c\t\td\r\n;\r\n"]
    texts += [prose(50 + 3 * k) for k in range(12)] + ["日本語のテキスト " * 20, "naïve Ａ ﬁ Σίσυφος İ <|endoftext|> don't", "123 456"]
    rows = [(k, t, ("de", "fr", None)[k % 3], f"s{k % 3}" if k % 4 else None, len(t), "x", 1, 2, 3, 4, 5, 6) for k, t in enumerate(texts)]
    rows += [(0, texts[0], None, None, None, None, None, None, None, None, None, None)]  # a repeated row
    rows += [(4, "another text under a used id " * 30, *[None] * 10), (None, base, *[None] * 10), (None, None, *[None] * 10)]
    rows += [(900, None, *[None] * 10), (901, passage + " and more", *[None] * 10)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


# Rules by host


def measures(text):
    w = split(text)
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_host_rules(docs, rows, empty):
    got = counted(host_rules.judged(docs), "doc_id", *host_rules.MEASURES, "base_failed")
    assert got == Counter((r[0], *(m := measures(r[1])), m[0] < 50 or 100 * m[4] > 50 * m[0]) for r in rows)
    assert host_rules.judged(empty).count() == host_rules.kept(empty).count() == 0
    kept = host_rules.kept(docs)
    assert kept.columns == docs.columns
    hosts = {r["host"]: r["host_kept"] for r in host_rules.judged(docs).select("host", "host_kept").distinct().collect()}
    good = [r for r in rows if (m := measures(r[1]))[0] >= 50 and 100 * m[4] <= 50 * m[0] and hosts[r[3] or ""]]
    assert counted(kept, "doc_id", "text", "source") == Counter((r[0], r[1], r[3]) for r in good)


def test_bad_host_takes_its_documents_along_but_a_small_one_is_pulled_to_the_rest(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, good, "a") for i in range(60)] + [(i, bad, "b") for i in range(60, 110)] + [(i, good, "b") for i in range(110, 115)]
    rows += [(i, good, f"h{i}") for i in range(200, 230)] + [(300, bad, "c"), (301, good, "c")]
    got = host_rules.judged(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    verdict = {r["host"]: (r["host_kept"], r["host_rate"]) for r in got.select("host", "host_kept", "host_rate").distinct().collect()}
    assert not verdict["b"][0] and verdict["a"][0] and verdict["c"][1] < 0.5
    assert got.filter("host = 'b' AND kept").count() == 0 and got.filter("host = 'a' AND kept").count() == 60


# Token ids


def encode(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids


def test_token_files_hold_what_the_library_encodes(spark, docs, rows, empty, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write(docs, path, WORDS)
    stored = [(r["doc_id"], r["ids"]) for r in token_files.read(spark, path).collect()]
    assert Counter((i, tuple(x)) for i, x in stored) == Counter((r[0], (*encode(r[1]), 2)) for r in rows)
    got = token_files.digest(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is None, x))
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]
    crc = lambda ids: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((i, crc(x)) for i, x in stored)
    assert token_files.read(spark, path, 3, 5).select("doc_id").distinct().count() == 3
    assert token_files.lengths(spark, path).count() == len(rows)
    token_files.write(empty, str(tmp_path / "none"), WORDS)
    assert token_files.digest(spark, str(tmp_path / "none")).count() == 0


def test_token_files_are_dictionary_and_delta_encoded_with_small_groups(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "ids"
    many = docs.crossJoin(spark.range(60)).select((F.col("doc_id") * 100 + F.col("id")).alias("doc_id"), "text")
    token_files.write(many, str(path), WORDS, row_group_bytes=4 << 10, page_bytes=1 << 10)
    files = [pq.ParquetFile(f) for f in path.glob("*.parquet")]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    assert len(groups) > len(files)
    for g in groups:
        columns = {g.column(k).path_in_schema: g.column(k) for k in range(g.num_columns)}
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
        assert all(c.has_column_index or c.has_offset_index for c in columns.values())


def test_token_lengths(spark, docs, rows, empty):
    lengths = [len(encode(r[1])) for r in rows]
    table = token_lengths.limits(token_lengths.histogram(token_lengths.document_lengths(docs, WORDS)))
    got = {r["n_tokens"]: r.asDict() for r in table.collect()}
    assert set(got) == set(lengths)
    for limit, r in got.items():
        assert r["n_docs"] == lengths.count(limit) and r["total_tokens"] == sum(lengths)
        assert r["docs_longer"] == sum(x > limit for x in lengths) and r["docs_fitting"] + r["docs_longer"] == len(lengths)
        assert r["kept_tokens"] == sum(min(x, limit) for x in lengths)
    assert token_lengths.quantile(table, 0.5).first()[0] == sorted(lengths)[(len(lengths) - 1) // 2]
    assert token_lengths.kept_at(token_lengths.histogram(token_lengths.document_lengths(docs, WORDS)), 7).first()[0] == sum(min(x, 7) for x in lengths)
    assert token_lengths.limits(token_lengths.histogram(token_lengths.document_lengths(empty, WORDS))).count() == 0


def test_lengths_over_blocks_of_the_histogram(spark):
    counts = {n * 997 % 20_000: n for n in range(1, 200)}
    got = token_lengths.limits(spark.createDataFrame(list(counts.items()), "n_tokens long, n_docs long")).collect()
    for r in got:
        assert r["kept_tokens"] == sum(min(k, r["n_tokens"]) * n for k, n in counts.items())


# Repeated passages


def removed_bytes(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    for r, t in zip(rows, texts, strict=True):
        gone = {k + j for k in range(len(t) - length + 1) if seen[t[k : k + length]] > 1 for j in range(length)}
        kept = bytes(b for k, b in enumerate(t) if k not in gone)
        yield r[0], len(t), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [400, 40])
def test_suffix_levels(docs, rows, empty, length):
    got = counted(suffix_levels.digest(docs, length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(removed_bytes(rows, length))
    assert suffix_levels.digest(empty, length).count() == 0


@pytest.mark.parametrize("module, name", [(suffix_levels, "byte"), (automata, "word")])
def test_frequent_anchors_are_dealt_out_by_window(spark, rows, module, name, monkeypatch):
    rng = random.Random(5)
    prose = lambda n: " ".join(str(rng.randint(0, 999)) for _ in range(n))
    shared = prose(30)
    table = [(k, f"{prose(20)} {shared} {prose(20)}") for k in range(60)]
    plain = module.scheme
    from dataclasses import replace

    monkeypatch.setattr(module, "scheme", lambda *a: replace(plain(*a), most_segments=4))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    if name == "byte":
        assert counted(module.digest(docs, 60), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(removed_bytes(table, 60))
    else:
        assert counted(module.digest(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(removed_words(table, 13))


@pytest.mark.parametrize("module, name", [(suffix_levels, "byte"), (automata, "word")])
def test_one_document_that_holds_one_segment_very_often(spark, module, name, monkeypatch):
    from dataclasses import replace

    plain = module.scheme
    monkeypatch.setattr(module, "scheme", lambda *a: replace(plain(*a), most_segments=16))
    table = [(1, "spam " * 900 + "and eggs"), (2, "with spam " + "spam " * 40), (3, "eggs " + "spam " * 20 + "ham"), (None, "spam " * 50), (None, "spam " * 30 + "tea")]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    if name == "byte":
        assert counted(module.digest(docs, 60), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(removed_bytes(table, 60))
    else:
        assert counted(module.digest(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(removed_words(table, 13))


@pytest.mark.parametrize("module, name", [(suffix_levels, "byte"), (automata, "word")])
def test_equal_rows_under_one_id_get_each_range_once(spark, module, name):
    """The list of a row's ranges doesn't grow with the number of its copies."""
    from tillwarden.llm import passages

    rng = random.Random(8)
    prose = lambda n: " ".join(str(rng.randint(0, 999)) for _ in range(n))
    shared = prose(40)
    table = [(None, f"{prose(30)} {shared}")] * 2000 + [(1, f"{shared} {prose(30)}"), (2, prose(60))]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(7)
    length, keyed = (60 if name == "byte" else 13), passages.keyed(docs)
    found = passages.with_ranges(keyed, passages.find(keyed, module.scheme(length), module._compare(length)))
    sizes = [len(r["_starts"] or []) for r in found.collect()]
    assert len(sizes) == len(table) and max(sizes) < 40
    if name == "byte":
        few = [table[0]] * 2 + table[-2:]
        expected = dict(((r[0], r[1]), r) for r in removed_bytes(few, 60))
        got = counted(module.digest(docs, 60), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert sum(got.values()) == len(table) and set(got) == set(expected.values())


@pytest.mark.parametrize("module, name", [(suffix_levels, "byte"), (automata, "word")])
def test_long_texts_come_in_parts(spark, module, name, monkeypatch):
    """Every window of a text longer than a part is in one segment, whatever the cuts."""
    from tillwarden.llm import passages

    monkeypatch.setattr(passages, "LONG", passages.LONG)
    rng = random.Random(10)
    prose = lambda n: " ".join(str(rng.randint(0, 99)) for _ in range(n))
    shared = prose(60)
    table = [(2, f"{prose(300)} {shared} {prose(190)} {shared} {prose(40)}"), (1, f"{prose(5)} {shared}"), (3, shared[20:] + prose(400)), (4, prose(900)), (5, "so " * 600)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    scheme = module.scheme(60 if name == "byte" else 13)
    from tillwarden.llm.text import chunk_of, keyed

    batch = keyed(docs).toArrow().combine_chunks().to_batches()[0]
    whole = {(int(e["id"]), int(s)) for e in _entries(passages, scheme, batch, chunk_of, 1 << 21) for s in range(int(e["start"]), int(e["start"] + e["n"]))}
    parts = [(int(e["id"]), int(s)) for e in _entries(passages, scheme, batch, chunk_of, 130) for s in range(int(e["start"]), int(e["start"] + e["n"]))]
    assert len(parts) == len(set(parts)) and set(parts) == whole


def _entries(passages, scheme, batch, chunk_of, long):
    passages.LONG = long
    for k in range(batch.num_rows):
        yield from passages.entries_of(scheme, chunk_of(batch.slice(k, 1), "_text"))


def test_suffix_family_merges_levels_and_finds_old_and_new():
    import numpy as np

    rng = np.random.default_rng(1)
    family, seen, found = suffix_levels.SuffixFamily(6), [], set()
    for k in range(40):
        data = rng.integers(0, 3, 50, dtype=np.uint8)
        starts = np.arange(45)
        found |= set(family.add(data, starts, starts + 45 * k).tolist())
        seen += [data[s : s + 6].tobytes() for s in starts]
    times = Counter(seen)
    assert found == {k for k, s in enumerate(seen) if times[s] > 1}
    assert len(family.levels) <= 8
    assert all((level.keys[1:] >= level.keys[:-1]).all() for level in family.levels)


def test_texts_without_repeats_stay_valid_and_keep_their_columns(docs, empty):
    out = suffix_levels.without_repeats(docs, 40)
    assert out.columns == docs.columns and out.count() == docs.count()
    left = {(r["doc_id"], r["text"]) for r in out.collect()}
    digests = {r["doc_id"]: r["kept_sha256"] for r in suffix_levels.digest(docs, 40).collect()}
    same = [hashlib.sha256((t or "").encode()).hexdigest() == digests[i] for i, t in left if i not in (None, 4)]
    assert sum(same) > 0.8 * len(same)  # others lost part of a character
    assert {t for i, t in left if i is None} >= {None}
    assert suffix_levels.without_repeats(empty).count() == 0


def removed_words(rows, window):
    first = {}
    large = 2**63 - 1
    for r in rows:
        w = split(r[1])
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, large), large if r[0] is None else r[0])
    for r in rows:
        w, own = split(r[1]), large if r[0] is None else r[0]
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < own for j in range(window)}
        yield r[0], len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()


@pytest.mark.parametrize("window", [13, 4])
def test_suffix_automata(docs, rows, empty, window):
    got = counted(automata.digest(docs, window), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(removed_words(rows, window))
    assert automata.digest(empty, window).count() == 0


def test_automaton_against_all_substrings():
    rng = random.Random(2)
    sequences = [([rng.randint(0, 2) for _ in range(rng.randint(0, 30))], owner) for owner in range(12)]
    shard = automata.Automaton(sequences)
    for length in (1, 3, 5):
        least = defaultdict(lambda: 99)
        for s, owner in sequences:
            for k in range(len(s) - length + 1):
                least[tuple(s[k : k + length])] = min(least[tuple(s[k : k + length])], owner)
        for owner in (0, 4, 99):
            text = [rng.randint(0, 2) for _ in range(80)]
            assert shard.covered(text, length, owner) == [k for k in range(len(text) - length + 1) if least[tuple(text[k : k + length])] < owner]


def test_reference_passages_go_and_too_large_ones_are_refused(spark, docs, empty):
    reference = spark.createDataFrame([(ITEM,), (None,), ("",)], "text string").withColumn("doc_id", F.lit(1))
    got = {r["doc_id"]: r for r in automata.without_passages(docs, reference).collect() if r["n_removed"]}
    assert len(got) == 2 and all(ITEM not in r["kept_text"] for r in got.values())
    assert automata.without_passages(docs, reference.limit(0)).filter("n_removed > 0").count() == 0
    with pytest.raises(ValueError, match="broadcast"):
        automata.without_passages(docs, docs, most_words=10)


# Similarity


def shingles(text):
    w = split(text)
    n = min(5, len(w))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


@pytest.mark.parametrize("settings", [jaccard_join.JoinSettings(), jaccard_join.JoinSettings(group_block=2, cluster_block=2)])
def test_jaccard_join(docs, rows, empty, settings):
    sets = [shingles(r[1]) for r in rows]
    large = 2**63 - 1
    ids = [large if r[0] is None else r[0] for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k in range(len(rows)):
        least[root(k)] = min(least.get(root(k), large), ids[k])
    expected = Counter((rows[k][0], None if least[root(k)] == large else least[root(k)], links[k]) for k in range(len(rows)))
    assert counted(jaccard_join.joined(docs, settings), "doc_id", "class_id", "n_links") == expected
    assert jaccard_join.joined(empty, settings).count() == jaccard_join.one_of_each(empty, settings).count() == 0
    kept = jaccard_join.one_of_each(docs, settings)
    assert kept.columns == docs.columns
    assert kept.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]")).count() == len({root(k) for k in range(len(rows)) if sets[k]})


def test_large_near_group_over_blocks(spark):
    rng = random.Random(9)
    base = [str(rng.randint(0, 10**6)) for _ in range(120)]
    table = []
    for k in range(90):
        w = list(base)
        w[rng.randrange(120)] = f"e{k}"
        table.append((k, " ".join(w)))
    settings = jaccard_join.JoinSettings(group_block=16, cluster_block=25)
    got = jaccard_join.joined(spark.createDataFrame(table, "doc_id long, text string"), settings).collect()
    sets = [shingles(t) for _, t in table]
    n = [sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for a in sets]
    assert {r["class_id"] for r in got} == {0} and {r["doc_id"]: r["n_links"] for r in got} == dict(enumerate(n))


def test_pruning_bounds_follow_the_posterior():
    bounds = jaccard_join.least_matches(jaccard_join.JoinSettings())
    assert [n for n, _ in bounds] == list(range(16, 129, 16))
    assert all(0 < m < 0.8 * n for n, m in bounds) and all(a[1] <= b[1] for a, b in zip(bounds, bounds[1:], strict=False))


def test_components_of_chains_and_stars(spark):
    from tillwarden.llm.components import components

    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 201), (203, 201), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 130))
    assert [got[k] for k in (200, 201, 203)] == [200] * 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Benchmark items


def test_decontamination(spark, docs, rows, empty):
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (None, ITEM), (5, "one"), (6, "two words")], "item_id long, text string")
    lower = lambda t: [x.translate({c: c + 32 for c in range(65, 91)}) for x in split(t)]

    def bag(w):
        n = min(5, len(w))
        return Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))

    expected = Counter()
    for r in rows:
        w, hit = lower(r[1]), []
        for i, text in ((1, ITEM), (2, ITEM), (5, "one"), (6, "two words")):
            item = lower(text)
            width = min(5, len(item))
            whole = Counter(tuple(item[k : k + width]) for k in range(len(item) - width + 1))
            for k in range(max(1, len(w) - len(item) + 1) if w else 0):
                part = w[k : k + len(item)]
                own = Counter(tuple(part[a : a + width]) for a in range(len(part) - width + 1))
                both = (own & whole).total()
                if both >= 0.8 * (own.total() + whole.total() - both):
                    hit.append(i)
                    break
        expected[r[0], tuple(hit)] += 1
    for words_ in (10**6, 20):
        got = decontaminate.judged(docs, items, decontaminate.Decontamination(block_words=words_))
        assert Counter((r["doc_id"], tuple(r["item_ids"])) for r in got.collect()) == expected
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(n for (_, hit), n in expected.items() if not hit)
    assert decontaminate.judged(empty, items).count() == 0
    assert decontaminate.judged(docs, items.limit(0)).filter("contaminated").count() == 0


def test_items_are_found_in_any_case_of_any_alphabet(spark):
    items = [
        (1, "la acción de los niños pequeños fue aquí una gran decisión común de la nación española"),
        (2, "l'été où l'élève préféré a été gêné par ça près de la forêt brûlée là-bas déjà"),
        (3, "die große Straße führt weiß Gott außen über die Brücke und schließt für Fußgänger abends"),
        (4, "ο μεγάλος δρόμος της πόλης είναι κλειστός για όλους τους πεζούς σήμερα το βράδυ"),
        (5, "Русский текст о том как буквы пишут прописными и строчными в одной строке"),
    ]
    forms = {"upper": str.upper, "lower": str.lower, "title": str.title, "fold": str.casefold, "same": str}
    assert all(a in forms["upper"](items[0][1]) for a in ("CIÓN", "ÑOS"))
    texts = [(10 * i + k, i, f"Vor ÄÖÜ dem\u00a0Text {form(text)} danach éàç") for i, text in items for k, form in enumerate(forms.values())]
    docs = spark.createDataFrame([(d, text) for d, _, text in texts] + [(1000, "ÉTÉ " * 40), (1001, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.judged(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {d: list(r["item_ids"]) for d, r in got.items()} == {d: [i] for d, i, _ in texts} | {1000: [], 1001: []}
    assert all(r["best_similarity"] == 1.0 for d, r in got.items() if d < 1000)
    kept = decontaminate.clean(docs, spark.createDataFrame(items[1:], "item_id long, text string"))
    before = {d: text for d, i, text in texts if i == 1} | {1000: "ÉTÉ " * 40, 1001: None}
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == before


def test_windows_around_a_long_item_are_listed_once():
    import numpy as np

    rng = np.random.default_rng(6)
    item = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    fill = rng.integers(0, 2**63, 500, dtype=np.uint64)
    short = rng.integers(0, 2**63, 9, dtype=np.uint64)
    index = decontaminate.ItemIndex([(1, item), (2, short)], decontaminate.Decontamination())
    texts = [np.concatenate([fill, item, fill]), item[:3900], np.concatenate([fill[:3], short, fill[3:9], short]), fill[:2]]
    hashes, first = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    for width, _, owner, start, n, size in index.windows(hashes, first):
        places = list(zip(start.tolist(), size.tolist(), strict=True))
        expected = set()
        for d, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            for whole in (4000, 9):
                held = np.isin(hashes[a:b], item if whole == 4000 else short).astype(int)
                runs = np.convolve(held, np.ones(5, int), "valid") == 5 if b - a >= 5 else np.zeros(0, bool)
                at = np.flatnonzero(runs)
                for s in range(max(1, b - a - whole + 1)):
                    if ((at >= s) & (at + 5 <= s + whole)).any():
                        expected.add((s + a, whole))
        assert width == 5 and len(set(places)) == len(places) and set(places) == expected
    assert [(d, i, place, n) for d, i, place, n, _ in index.matches(hashes, first)] == [(0, 0, 500, 4000), (1, 0, 0, 3900), (2, 1, 3, 9)]


def test_multi_index_finds_every_fingerprint_within_the_radius():
    rng = random.Random(4)
    import numpy as np

    items = [(k, np.array([rng.getrandbits(64) for _ in range(12)], np.uint64)) for k in range(20)]
    index = decontaminate.ItemIndex(items, decontaminate.Decontamination())
    for k in range(20):
        for _ in range(30):
            value = int(index.prints[k])
            for bit in rng.sample(range(64), 23):
                value ^= 1 << bit
            assert k in index.candidates(12, value)


# Segmentations


def test_piece_sampling_is_lossless_and_reproducible(docs, rows, empty):
    import sentencepiece

    encoded = piece_sampling.encode(docs, PIECES)
    ids = {(r["doc_id"], tuple(r["ids"])) for r in encoded.collect()}
    assert ids == {(r["doc_id"], tuple(r["ids"])) for r in piece_sampling.encode(docs.repartition(2), PIECES).collect()}
    assert ids != {(r["doc_id"], tuple(r["ids"])) for r in piece_sampling.encode(docs, PIECES, seed=1).collect()}
    assert counted(piece_sampling.decode(encoded, PIECES), "doc_id", "text") == Counter((r[0], r[1] or "") for r in rows)
    assert piece_sampling.checked(docs, PIECES).filter("NOT lossless").count() == 0
    assert piece_sampling.checked(empty, PIECES).count() == piece_sampling.encode(empty, PIECES).count() == 0
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert {(i, sp.decode(list(x))) for i, x in ids} == {(r[0], r[1] or "") for r in rows}


def test_segmentations_are_drawn_by_their_weight(spark):
    import numpy as np

    p = piece_sampling.pieces(PIECES)
    word = b" then"

    def ways(rest):
        if not rest:
            return [((), 0.0)]
        return [((i, *more), p.weight[i] + w) for i in known if rest.startswith(p.spelled[i]) for more, w in ways(rest[len(p.spelled[i]) :])]

    known = [i for i, s in enumerate(p.spelled) if s and s in word and i not in set(p.byte_piece)]
    every = dict(ways(word))
    total = sum(np.exp(w) for w in every.values())
    n = 20_000
    got = Counter(tuple(r["ids"]) for r in piece_sampling.encode(spark.range(n).selectExpr("id AS doc_id", "'then' AS text"), PIECES).collect())
    for ids, w in every.items():
        share = np.exp(w) / total
        assert abs(got[ids] / n - share) < 5 * np.sqrt(share / n) + 1e-4


# Models


def test_quality_model_learns_and_scores_every_row(spark, docs, rows, empty):
    rng = random.Random(1)
    good = lambda: " ".join(rng.choice(["river", "stone", "green", "walks", "under", "light"]) + rng.choice("abcde") for _ in range(60))
    table = [(k, good() if k % 3 else " ".join(f"{rng.choice('XYZ') * 4}!!###" for _ in range(40)), "s", 9) for k in range(400)]
    texts = spark.createDataFrame(table, "doc_id long, text string, score string, n_chars long")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(400)] + [(None, 1), (5, None)], "doc_id long, quality int")
    settings = quality_fm.FmSettings(bits=8, sample=200)
    model = quality_fm.fit(texts, labels, settings)
    got = {r["doc_id"]: r for r in quality_fm.scored(texts, model).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(got[k]["predicted"] == int(k % 3 > 0) for k in held) >= 0.97 * len(held)
    mixed = quality_fm.scored(docs, model)
    assert mixed.count() == len(rows) and mixed.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    none = quality_fm.fit(empty, labels, settings)
    assert quality_fm.scored(empty, none).count() == 0 and quality_fm.scored(docs, none).count() == len(rows)


def test_an_id_with_many_rows_is_one_of_the_sample(spark):
    from tillwarden.llm.samples import labelled_sample

    docs = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.when(F.col("id") > 2, F.concat(F.lit("t"), F.col("id") % 7)).alias("text"), F.lit(None).cast("long").alias("n_chars"))
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", F.lit(True), 10)
    assert sorted(map(tuple, got.select("doc_id", "label", "text", "n_chars").collect())) == [(0, 0, "t6", None), (1, 1, "t6", None)]
    assert labelled_sample(docs, labels, "quality", F.lit(True), 1).count() == 1


def test_linear_time_interactions_equal_all_pairs(spark):
    import numpy as np
    import pyarrow as pa
    from tillwarden.llm.text import chunk_of

    rng = np.random.default_rng(3)
    width = 16 + len(quality_fm.STATISTICS)
    model = quality_fm.FmModel(4, 0.3, rng.normal(size=width), rng.normal(size=(width, 3)), np.zeros(13), np.ones(13))
    chunk = chunk_of(pa.RecordBatch.from_pydict({"text": ["a b c a", "", "x y"], "n_chars": pa.array([7, None, 3], pa.int64())}))
    owner, bucket, share, stats = quality_fm.features(chunk, 4)
    got = quality_fm.raw_scores(model, chunk)
    for d in range(3):
        x = np.zeros(width)
        x[bucket[owner == d]] = share[owner == d]
        x[16:] = stats[d].clip(-4, 4)
        pairs = sum(model.factors[i] @ model.factors[j] * x[i] * x[j] for i in range(width) for j in range(i))
        assert got[d] == pytest.approx(0.3 + model.linear @ x + pairs)


def test_language_model_and_rejection(spark, docs, rows, empty):
    rng = random.Random(2)
    kinds = {"aa": ["wolm", "kran", "tuben", "schlo"], "bb": ["osci", "alora", "mentia", "que"]}
    say = lambda lang, n: " ".join(rng.choice(kinds[lang]) + rng.choice(kinds[lang]) for _ in range(n))
    table = [(k, say(lang := ("aa", "bb")[k % 2], rng.randint(2, 40)), lang if k % 7 else None) for k in range(400)]
    texts = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = language.fit(texts, language.LanguageSettings(bits=10, sample=200))
    got = {r["doc_id"]: r for r in language.predicted(texts, model).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    assert sum(got[k]["lang_pred"] == ("aa", "bb")[k % 2] for k in held) >= 0.98 * len(held)
    found = language.predicted(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    letters = Counter((r[0], any(c.isalpha() for c in r[1] or "")) for r in rows)
    assert Counter((r["doc_id"], r["lang_pred"] != "und") for r in found) == letters
    assert all(r["rejected"] for r in found if r["lang_pred"] == "und")
    assert language.predicted(empty, language.fit(empty, language.LanguageSettings(bits=10))).count() == 0


def test_very_long_texts_without_spaces_are_encoded_as_well():
    """Writing without spaces falls into units, a run of one letter goes arc by arc; ids do not
    depend on what else is in the chunk."""
    import numpy as np
    import pyarrow as pa

    from tillwarden.llm.text import chunk_of

    rng = random.Random(3)
    p = piece_sampling.pieces(PIECES)
    texts = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(20_000)), "a" * 3000, "ab" * 900, "x" * 300, "so it goes", "ﷺ日本" * 50]

    def sampled(some):
        batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in some], pa.string())], ["text"])
        ids, cuts = piece_sampling.sampled(p, chunk_of(batch), np.array([k for k, _ in some], np.uint64), 1.0)
        return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    together = sampled(list(enumerate(texts)))
    for k, (text, ids) in enumerate(zip(texts, together, strict=True)):
        assert piece_sampling.decoded(p, ids).decode() == text
        assert sampled([(k, text)]) == [ids]


def test_the_rest_of_a_long_unit_is_drawn_as_the_rest_would_be(monkeypatch):
    """Arc by arc or side by side: the same ids."""
    import numpy as np
    import pyarrow as pa

    from tillwarden.llm.text import chunk_of

    p = piece_sampling.pieces(PIECES)
    batch = pa.RecordBatch.from_arrays([pa.array(["abcabcaba" * 60, "the" * 100, "a b c"], pa.string())], ["text"])
    got = []
    for levels, few in ((256, 8), (100_000, 0), (3, 100)):
        monkeypatch.setattr(piece_sampling, "LEVELS", levels)
        monkeypatch.setattr(piece_sampling, "FEW_WALKS", few)
        ids, cuts = piece_sampling.sampled(p, chunk_of(batch), np.array([1, 2, 3], np.uint64), 0.7)
        got.append((ids.tolist(), cuts.tolist()))
    assert got[0] == got[1] == got[2]


def test_windows_of_one_long_text_are_looked_up_in_stretches(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    items = [(k, rng.integers(0, 2**63, 60 + k, dtype=np.uint64)) for k in range(12)]
    text = rng.integers(0, 2**63, 30_000, dtype=np.uint64)
    for k, (_, item) in enumerate(items):
        text[2000 * k + 77 : 2000 * k + 77 + len(item)] = item
    index = decontaminate.ItemIndex(items, decontaminate.Decontamination())
    whole = index.matches(text, np.array([0, len(text)]))
    plain = decontaminate._stretches
    monkeypatch.setattr(decontaminate, "_stretches", lambda start: plain(start, 40))
    assert index.matches(text, np.array([0, len(text)])) == whole
    assert [(i, place) for _, i, place, _, s in whole if s == 1.0] == [(k, 2000 * k + 77) for k in range(12)]


def plain_subwords(text, bits):
    """Buckets of the runs of 2 to 4 bytes, one by one."""
    data = bytearray(b" " + re.sub(rb"[\x20\x09-\x0D]", b" ", (text or "").encode()).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) + b" ")
    for k in range(1, len(data)):
        if data[k - 1] == 0xC3 and 0x80 <= data[k] <= 0x9E:
            data[k] += 0x20
    for size in (2, 3, 4):
        for k in range(len(data) - size + 1):
            run = data[k : k + size]
            if run[:2] == b"  " or 0x20 in run[1:-1]:
                continue
            mixed = 0x165667B1 * size % 2**32
            for b, factor in zip(run, (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F), strict=False):
                mixed = (mixed + (b + 1) * factor) % 2**32
                mixed ^= mixed >> 15
            yield mixed * 0x9E3779B1 % 2**32 >> 32 - bits


def test_language_scores_by_plain_loops(spark, docs, rows):
    import numpy as np

    rng = np.random.default_rng(4)
    model = language.LanguageModel(6, ("aa", "bb", "cc"), rng.normal(size=(64, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32), 0.7, 0.5)
    expected = Counter()
    for r in rows:
        found = list(plain_subwords(r[1], 6))
        z = [sum(float(model.table[b][c]) for b in found) / max(1, len(found)) + float(model.offset[c]) for c in range(3)]
        odds = [np.exp(x / 0.7) for x in z]
        best = max(range(3), key=lambda c: odds[c])
        known = any(c.isalpha() for c in r[1] or "")
        score = round(odds[best] / sum(odds), 9) if known else 0.0
        expected[r[0], model.languages[best] if known else "und", score, not known or score < 0.5] += 1
    got = Counter((r["doc_id"], r["lang_pred"], round(r["score"], 9), r["rejected"]) for r in language.predicted(docs, model).collect())
    assert got == expected


def test_quality_scores_by_plain_loops(spark, docs, rows):
    """Statistics, word shares and all pairs of features, text by text."""
    import numpy as np

    rng = np.random.default_rng(6)
    bits, width = 5, 32 + len(quality_fm.STATISTICS)
    center, scale = rng.normal(size=13), rng.uniform(0.5, 2, 13)
    model = quality_fm.FmModel(bits, 0.2, rng.normal(size=width), rng.normal(0, 0.3, size=(width, 2)), center, scale)
    expected = Counter()
    for r in rows:
        text = r[1] or ""
        w = split(text)
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = measures(r[1])
        chars, lines = max(1, len(text)), text.count("\n") + 1
        given = r[4] if len(r) > 4 and r[4] is not None else chars
        count = lambda test: sum(map(test, text))  # noqa: E731, B023
        per_word, per_char = 1 / max(n_words, 1), 1 / max(word_chars, 1)
        stats = [
            np.log1p(n_words), word_chars * per_word, n_symbols * per_char, n_repeat_words * per_word, n_dup_lines / lines,
            count(lambda c: "A" <= c <= "Z") * per_char, count(lambda c: "0" <= c <= "9") * per_char,
            count(lambda c: "!" <= c <= "~" and not c.isalnum()) * per_char, np.log1p(n_words / lines), None,
            sum(b >= 0x80 for b in text.encode()) * per_char, np.log1p(given), np.log1p(abs(given - (chars if chars > 1 else given))),
        ]
        x = np.zeros(width)
        hashes = {}
        for word in w:
            batch = pa_chunk(word)
            hashes[word] = int(words_of(batch)[0]) >> 64 - bits
        for word in w:
            x[hashes[word]] += 1 / len(w)
        stats[9] = len(set(hashes.values())) / np.sqrt(max(n_words, 1))
        x[32:] = ((np.array(stats) - center) / scale).clip(-4, 4)
        z = model.bias + x @ model.linear + sum(x[i] * x[j] * (model.factors[i] @ model.factors[j]) for i in range(width) for j in range(i))
        expected[r[0], round(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))), 6)] += 1
    scored = quality_fm.scored(docs, model).collect()
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in scored) == expected


def pa_chunk(text):
    import pyarrow as pa

    from tillwarden.llm.text import chunk_of

    return chunk_of(pa.RecordBatch.from_arrays([pa.array([text])], ["text"]))


def words_of(chunk):
    from tillwarden.llm.text import words

    return words(chunk).hashes
