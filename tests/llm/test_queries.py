"""The named queries and the pipeline over whole tables of the smallest scale, against brute force or SQL."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from test_operators import counted, encode, measures, removed_bytes, removed_words, shingles, split

import corpus_pipeline
import __spark_entry__ as entry
from tillwarden.llm import check_sql, piece_sampling, queries, suffix_levels


@pytest.fixture(scope="module")
def tables(sf_dir):
    read = lambda t: duckdb.sql(f"SELECT * FROM '{sf_dir}/{t}.parquet' ORDER BY 1").fetchall()
    return {t: read(t) for t in ("documents", "benchmark", "labels")}


def near_groups(rows):
    """The first row of each row's group, and its links."""
    sets = [shingles(r[1]) for r in rows]
    parent, links = list(range(len(rows))), Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(k) for k in range(len(rows))], links


def items_in(text, benchmark):
    lower = lambda t: split((t or "").casefold())
    bag = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    w, found = lower(text), []
    runs = set(bag(w))
    for i, item in benchmark:
        whole = bag(v := lower(item))
        if not runs & set(whole):
            continue
        for k in range(max(1, len(w) - len(v) + 1)):
            own = bag(w[k : k + len(v)])
            both = (own & whole).total()
            if both >= 0.8 * (own.total() + whole.total() - both):
                found.append(i)
                break
    return found


def run(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir)


def test_all_are_registered(spark):
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_held_out_quality(spark, sf_dir, tables):
    got = {r["doc_id"]: r for r in run(spark, sf_dir, "op1_quality_fm").collect()}
    assert set(got) == {r[0] for r in tables["documents"]}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for i, r in got.items())
    held = [(got[i]["predicted"], q) for i, q, _ in tables["labels"] if got[i]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.85 * len(held)


def test_token_files(spark, sf_dir, tables):
    start, expected = 0, []
    for r in tables["documents"]:
        ids = [*encode(r[1]), 2]
        expected.append((r[0], start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in run(spark, sf_dir, "op2_token_files").collect()) == expected


def test_repeated_strings(spark, sf_dir, tables):
    got = counted(run(spark, sf_dir, "op3_suffix_levels"), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(removed_bytes(tables["documents"], 400))


@pytest.mark.parametrize("length", [400, corpus_pipeline.PASSAGE_BYTES])
def test_repeated_strings_over_many_partitions(spark, length):
    """A larger table, dealt over 24 tasks, against a count of every string."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(24)
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    seen = Counter(hash(t[k : k + length]) for _, t in texts for k in range(len(t) - length + 1))
    expected = Counter()
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[hash(t[k : k + length])] > 1:
                gone[k : k + length] = b"x" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        expected[i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        got = counted(suffix_levels.digest(docs, length), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected and sum(r[2] > 0 for r in expected) > 100


def test_token_counts(spark, sf_dir, tables):
    lengths = [len(encode(r[1])) for r in tables["documents"]]
    got = {r["n_tokens"]: r["kept_tokens"] for r in run(spark, sf_dir, "op4_token_counts").collect()}
    assert got == {limit: sum(min(x, limit) for x in lengths) for limit in set(lengths)}


def test_held_out_language(spark, sf_dir, tables):
    got = {r["doc_id"]: r for r in run(spark, sf_dir, "op5_language_id").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[r[0]]["lang_pred"], r[2]) for r in tables["documents"] if got[r[0]]["held_out"]]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)


def test_words_of_earlier_documents(spark, sf_dir, tables):
    got = counted(run(spark, sf_dir, "op6_suffix_automata"), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(removed_words(tables["documents"], 13))


def test_segmentations_are_lossless(spark, sf_dir, tables):
    got = run(spark, sf_dir, "op7_piece_sampling")
    assert got.count() == len(tables["documents"]) and got.filter("NOT lossless").count() == 0


def test_host_rules_equal_their_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = run(spark, sf_dir, "op8_host_rules")
    rows = connection.execute(f"SELECT {', '.join(got.columns)} FROM ({check_sql.HOST_RULES.strip()})").fetchall()
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_near_duplicates(spark, sf_dir, tables):
    rows = tables["documents"]
    first, links = near_groups(rows)
    got = counted(run(spark, sf_dir, "op9_jaccard_join"), "doc_id", "class_id", "n_links", "keeper")
    assert got == Counter((r[0], rows[f][0], links[k], f == k) for k, (r, f) in enumerate(zip(rows, first, strict=True)))


def test_benchmark_items(spark, sf_dir, tables):
    got = {r["doc_id"]: list(r["item_ids"]) for r in run(spark, sf_dir, "op10_decontamination").collect()}
    assert got == {r[0]: items_in(r[1], tables["benchmark"]) for r in tables["documents"]}


def test_pipeline_equals_its_stages_by_brute_force(spark, sf_dir, tables):
    rows = [r for r in tables["documents"] if (m := measures(r[1]))[0] >= 50 and 100 * m[4] <= 50 * m[0]]
    verdicts = {r[0] for r in duckdb.sql(check_sql.HOST_RULES.replace("FROM documents", f"FROM '{sf_dir}/documents.parquet'")).fetchall() if r[-1]}
    rows = [r for r in rows if r[0] in verdicts]
    first, _ = near_groups(rows)
    rows = [r for k, r in enumerate(rows) if first[k] == k]
    texts = [(r[1] or "").encode() for r in rows]
    size = corpus_pipeline.PASSAGE_BYTES
    seen = Counter(t[k : k + size] for t in texts for k in range(len(t) - size + 1))
    kept = {}
    for r, t in zip(rows, texts, strict=True):
        gone = {k + j for k in range(len(t) - size + 1) if seen[t[k : k + size]] > 1 for j in range(size)}
        kept[r[0]] = bytes(b for k, b in enumerate(t) if k not in gone).decode("utf-8", "ignore")
    expected = {i: t for i, t in kept.items() if not items_in(t, tables["benchmark"])}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    p = piece_sampling.pieces(corpus_pipeline.PIECES)
    assert {r["doc_id"]: piece_sampling.decoded(p, r["ids"]).decode() for r in got} == expected
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_passages_over_fifty_words_do_not_stay_in_the_pipeline(spark):
    """Repeated prose of more than 50 words, of two to five letters each, goes in the third stage;
    documents without any stay as they are."""
    import random

    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))
    shared = [prose(51) for _ in range(20)]
    table = [(k, f"{prose(80)} {shared[k % 20]} {prose(80)}") for k in range(60)] + [(100 + k, prose(200)) for k in range(60)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_strings(spark, docs, "").collect()}
    assert not any(shared[k % 20] in left[k] or len(left[k]) > len(t) - len(shared[k % 20]) + 8 for k, t in table[:60])
    assert all(left[k] == t for k, t in table[60:])


def test_pipeline_over_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
