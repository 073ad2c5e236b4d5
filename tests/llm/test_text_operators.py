"""Text operators against SQL, the tokenizers' own libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import (
    byte_bpe,
    exact_dedup,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    queries,
    secret_scan,
    token_counts,
    topk_search,
    url_filter,
)

# Pieces of difficult texts: white space of all kinds, marks, signs, special strings.
ODD = ["a", "b", "A", "'s", "'ll", "'", "  ", " ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "\u200b"]
ODD += ["\u00e9", "e\u0301", "\u00f1", "1", "\u0663", "\u00b2", "!", "\u2026", "\U0001f600", "\u03a3", "\u0130"]
ODD += ["<|endoftext|>", "<|startoftext|>", "\r\n", "aaaa", "\x00", "\u1e9e", "\u212a"]


def odd_texts(count, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(ODD, k=draw.randint(0, 30))) for _ in range(count)] + ["", "a" * 3000]


@pytest.fixture(scope="module")
def texts(spark, sf_small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def hard(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, columns with clashing names."""
    rows = [
        (1, None, None, 1, "x"),
        (2, "", "en", 2, None),
        (3, " \t\n", "en", 3, "x"),
        (None, "one two three four five six", None, None, "x"),
        (5, "one two three four five six", "en", 5, "x"),
        (5, "one two three four five six", "en", 5, "x"),
        (6, "One  two three four five six", "en", 6, "x"),
        (7, "\u00e9 " * 30000, "fr", 7, "x"),
        (8, "... 123 !", "en", 8, "x"),
    ]
    names = "doc_id long, text string, lang string, n_chars long, digest string"
    return spark.createDataFrame(rows, names).withColumns(
        {c: F.lit(1) for c in ("node", "spans", "ids", "lines", "document", "class", "score", "host", "row_id")}
    )


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(name, spark, sf_small):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_small}/{table}.parquet'")
    result = con.execute(queries.ORACLE_SQL[name])
    columns = sorted(d[0] for d in result.description)
    order = [[d[0] for d in result.description].index(c) for c in columns]
    expected = sorted(repr([row[i] for i in order]) for row in result.fetchall())
    df = queries.QUERIES[name](spark, sf_small)
    assert sorted(df.columns) == columns
    assert sorted(repr(list(r)) for r in df.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", ["op6_url_filter", "op7_line_dedup", "op9_exact_dedup"])
def test_native_queries_run_no_python(name, spark, sf_small):
    plan = queries.QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- tokens -----------------------------------------------------------------------------


def test_token_counts_equal_the_library(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    merges = token_counts.merges_of(public_tokenizers.path(token_counts.VOCABULARY))
    some = [*odd_texts(4000), *texts.values(), "ab" * 3000, " " * 500]
    assert merges.count(some) == [len(e.ids) for e in tokenizer.encode_batch(some, add_special_tokens=False)]


def test_token_count_query_equals_the_library(spark, sf_small, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    ids = list(texts)
    encoded = tokenizer.encode_batch([texts[i] or "" for i in ids], add_special_tokens=False)
    expected = {i: (len((texts[i] or "").encode()), len(e.ids), len(e.ids) > 512) for i, e in zip(ids, encoded)}
    found = token_counts.query(spark, sf_small).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in found} == expected
    assert {r.over_limit for r in found} == {True, False} and len(found) == len(texts)


def test_packed_ids_equal_the_library(texts):
    path = public_tokenizers.path(packing.VOCABULARY)
    some = [*odd_texts(4000), *texts.values()]
    expected = Tokenizer.from_file(path).encode_batch(some, add_special_tokens=False)
    assert [i.tolist() for i in packing.words_of(path).ids(some)] == [e.ids for e in expected]


def test_stretches_keep_the_ids(texts):
    codec = byte_bpe.encoding(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    for text in [*odd_texts(2000), *list(texts.values())[:50]]:
        for length in (3, 17, 100):
            parts = list(byte_bpe.stretches(text, length))
            assert "".join(parts) == text
            assert [i for p in parts for i in codec.encode_ordinary(p)] == codec.encode_ordinary(text)


def test_long_runs_of_white_space():
    codec = byte_bpe.encoding(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    runs = [" ", "\n", "\u3000", " \n"]
    for run in runs:
        for n in (byte_bpe.RUN // len(run), 60_000):
            for text in (f"w{run * n}end", f"w{run * n}", f"{run * n}1", f"a{run * n}!{run * n} x{run}y", f"{run * n}\tz"):
                assert byte_bpe.ids_of(codec, text).tolist() == codec.encode_ordinary(text)
    for run in runs:
        # The library itself fails at this length.
        text = f"word{run * 2_500_000} end"
        ids = byte_bpe.ids_of(codec, text)
        assert codec.decode_bytes(ids.tolist()).decode() == text
        assert ids[:1].tolist() == codec.encode_ordinary("word")[:1] and ids[-1:].tolist() == codec.encode_ordinary(" end")


def test_byte_bpe_round_trip(spark, sf_small, texts):
    codec = byte_bpe.encoding(public_tokenizers.path(byte_bpe.RANKS), public_tokenizers.PATTERN)
    for row in byte_bpe.query(spark, sf_small).collect():
        ids = codec.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_token_operators_on_hard_rows(hard):
    counted = {(r.doc_id, r.n_chars): (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(hard).collect()}
    assert counted[1, 1] == counted[2, 2] == (0, 0)
    assert counted[7, 7][0] == 90000
    assert byte_bpe.encode_documents(hard).where("doc_id = 7").first().decoded.decode() == "\u00e9 " * 30000
    for operator in (token_counts.count_tokens, byte_bpe.encode_documents):
        assert operator(hard).count() == 9
        assert operator(hard.limit(0)).count() == 0


# --- packing ----------------------------------------------------------------------------


def check_packing(found, documents, capacity=4096):
    """Every id in one piece, pieces gapless in sequences; returns the share of padding."""
    path = public_tokenizers.path(packing.VOCABULARY)
    tokenizer, held, sequences = Tokenizer.from_file(path), defaultdict(list), defaultdict(list)
    for r in found:
        held[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(held) == set(documents)
    for doc_id, rows in held.items():
        ids = np.array([*tokenizer.encode(documents[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    used = sum(length for parts in sequences.values() for _, length in parts)
    return 1 - used / (len(sequences) * capacity)


def test_packing(spark, sf_small, texts):
    assert check_packing(packing.query(spark, sf_small).collect(), texts) < 0.05


def test_packing_hard_rows(hard):
    found = packing.pack(hard.where("doc_id <> 5")).collect()
    check_packing(found, {1: None, 2: "", 3: " ", 6: "One two three four five six", 7: "\u00e9 " * 30000, 8: "... 123 !"})
    assert len([r for r in packing.pack(hard).collect() if r.doc_id == 5]) == 2
    assert packing.pack(hard.limit(0)).count() == 0


@pytest.mark.parametrize("capacity", [1000, 7])
def test_packing_of_any_capacity(capacity, spark):
    documents = {1: "one two " * 2000, 2: "a b c " * 330, 3: "x", 4: None, 5: "y " * 987}
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    check_packing(packing.pack(docs, capacity=capacity).collect(), documents, capacity)


@pytest.mark.parametrize("words", [0, 7, 19, 49])
def test_packing_of_short_texts(words, spark):
    """Sequences are as many as the tokens need at least, but for pieces that no longer fit."""
    documents = {i: "a " * words for i in range(12_000)}
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    found = packing.pack(docs).collect()
    sequences = Counter(r.sequence_id for r in found)
    assert {r.length for r in found} == {words + 1} and len(found) == len(documents)
    assert len(sequences) == -(-len(documents) // (4096 // (words + 1)))


def test_short_texts_fill_what_long_ones_leave(spark):
    draw = random.Random(3)
    documents = {i: "a " * 2500 for i in range(60)} | {100 + i: "a " * draw.randint(0, 160) for i in range(1500)}
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    assert check_packing(packing.pack(docs).collect(), documents) < 0.03


def test_poured_pieces_are_the_counted_ones():
    draw = random.Random(5)
    for _ in range(20):
        longs = {size: draw.randint(1, 40) for size in draw.sample(range(9, 257), 30)}
        shorts = {size: draw.randint(1, 3000) for size in draw.sample(range(1, 129), draw.randint(1, 128))}
        patterns = packing.plan({**longs, 1: draw.randint(1, 3000)}, 256)
        held = Counter()
        for counts, times in packing.poured(patterns, shorts, 256, 4096):
            assert sum((-size if size < 0 else 16 * size) * n for size, n in counts.items()) <= 4096
            held.update({size: n * times for size, n in counts.items()})
        assert held == Counter({**longs, **{-size: n for size, n in shorts.items()}})


def test_plan_holds_the_histogram():
    draw = random.Random(2)
    for top in (3, 300):
        histogram = {size: draw.randint(1, top) for size in draw.sample(range(1, 257), 60)}
        held = Counter()
        for counts, times in packing.plan(histogram, 256):
            assert sum(size * n for size, n in counts.items()) <= 256
            held.update({size: n * times for size, n in counts.items()})
        assert held == histogram
    assert packing.plan({}, 256) == []


# --- near and exact copies --------------------------------------------------------------


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(documents):
    """doc_id to (set size, component), by comparing all sets that share a shingle."""
    sets = {i: shingles(t) for i, t in documents.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in sets.items():
        for j, common in Counter(j for s in own for j in holders[s]).items():
            if 100 * common >= 75 * (len(own) + len(sets[j]) - common):
                parent[max(root(i), root(j))] = min(root(i), root(j))
        for s in own:
            holders[s].append(i)
    return {i: (len(own), root(i)) for i, own in sets.items()}


def test_jaccard_join_equals_brute_force(spark, sf_small, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.query(spark, sf_small).collect()}
    assert found == brute_components(texts)


@pytest.mark.parametrize("words", [9, 40, 150])
def test_jaccard_join_of_large_families(words, spark, monkeypatch):
    """Families about the threshold, and strangers that share a passage, with all keys frequent."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 4)
    draw = random.Random(words)
    vocabulary = [f"w{i}" for i in range(5000)]
    base, documents = draw.choices(vocabulary, k=words), {}
    for i in range(160):
        changed = [w if draw.random() > draw.choice((0.005, 0.02, 0.04)) else draw.choice(vocabulary) for w in base]
        documents[i] = " ".join(changed)
    for i in range(160, 220):
        documents[i] = " ".join([*base[: words // 2], *draw.choices(vocabulary, k=words)])
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_near(docs).collect()}
    assert found == brute_components(documents)


def test_jaccard_join_of_families_with_appended_text(spark):
    """Each member is linked to the base only, and its rare keys are all of its own text."""
    draw = random.Random(7)
    vocabulary, documents = [f"w{i}" for i in range(50000)], {}
    for family, size in enumerate((63, 127, 126, 1023)):
        base = draw.choices(vocabulary, k=size + 4)
        documents[100 * family] = " ".join(base)
        for i in range(1, 60):
            own = draw.choices(vocabulary, k=int(size * draw.uniform(0.3, 0.33)))
            documents[100 * family + i] = " ".join([*base, *own])
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_near(docs).collect()}
    assert found == brute_components(documents)


def test_jaccard_join_moves_all_keys_once(spark, monkeypatch):
    """Lists of keys are opened to count them and to find those shared, and go through no other step."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    plans, made = {}, jaccard_join.materialize

    def spied(df, name):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return made(df, name)

    monkeypatch.setattr(jaccard_join, "materialize", spied)
    text = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}-"), F.expr(f"id div {4 if i < 20 else 1}")) for i in range(30)])
    docs = spark.range(40).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert jaccard_join.join_near(docs).count() == 40
    assert [name for name, plan in plans.items() if "explode(keys" in plan] == ["shared-keys", "shared-members"]
    # The lists end in a projection to their lengths, below the join with the frequent keys.
    join = plans["common"].index("Join Inner")
    assert "keys#" not in plans["common"][:join]


@pytest.mark.parametrize("blocks", [16, 4096])
def test_jaccard_join_of_pages_with_shared_parts(blocks, spark, monkeypatch):
    """Texts of frequent parts, rare words or both, whose links none of a key's pivots gives."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", blocks)
    draw, documents = random.Random(11), {}
    parts = [[f"p{k}x{i}" for i in range(size)] for k, size in enumerate((12, 12, 15, 20, 24, 30, 60))]
    few = [[f"r{k}x{i}" for i in range(6)] for k in range(12)]
    for i in range(260):
        own = [f"o{i}x{k}" for k in range(draw.choice((0, 0, 2, 4, 9)))]
        chosen = draw.sample(parts, draw.choice((1, 2, 3)))
        documents[i] = " ".join([w for p in chosen for w in p] + draw.choice([*few, [], []]) + own)
    docs = spark.createDataFrame(list(documents.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_near(docs).collect()}
    assert found == brute_components(documents)


def test_pages_of_one_footer_meet_no_other_page(spark, monkeypatch):
    """22 of 26 words shared: similarity 0.69, all keys of the footer frequent, no set compared."""
    held = []

    def meetings(groups, made=jaccard_join._meetings):
        held.append((len(groups), made(groups)))
        return held[-1][1]

    monkeypatch.setattr(jaccard_join, "_meetings", meetings)
    footer = [f"f{i}" for i in range(22)]
    text = F.concat_ws(" ", *[F.concat(F.lit(f"o{k}x"), "doc_id") for k in range(4)], F.lit(" ".join(footer)))
    found = jaccard_join.join_near(spark.range(5000).select(F.col("id").alias("doc_id"), text.alias("text")))
    assert found.where("n_shingles <> 22 OR component_id <> doc_id").isEmpty()
    assert found.count() == 5000
    assert held == [(1, [])]


def test_groups_meet_where_both_sizes_allow_it():
    def group(name, least, reach, outside=1):
        sizes = {"all": 9000, "outside": outside, "characters": 10, "outside_characters": 10}
        return {"band": 4, "group": name, "least": least, "reach": reach, **sizes}

    found = jaccard_join._meetings([group(1, 20, 26), group(2, 25, 21), group(3, 24, 23, 0)])
    # 2 and 3 are too large for 2, and 3 has no set outside.
    assert found == [(4, 1, 1, 1, 3), (4, 1, 1, 2, 3), (4, 1, 1, 3, 3), (4, 2, 1, 1, 3)]


def test_needed_keys_outnumber_what_a_linked_set_may_lack():
    assert [jaccard_join.needed(n, n, n.bit_length() - 1) for n in (1, 3, 60, 63)] == [1, 2, 21, 22]
    for sketched in (32, 48, 64):
        assert sketched / 4 + 12 < jaccard_join.needed(1000 * sketched, sketched, 15) < sketched


def test_sets_that_share_a_number_stay_apart(spark):
    rows = [(1, 1, 9, 7, 50), (2, 2, 9, 7, 40), (3, 3, 9, 7, 50), (4, 4, 9, 8, 50), (5, 5, 0, None, None)]
    names = "doc_id long, text_hash long, n long, node long, check long"
    sketches = spark.createDataFrame(rows, names).withColumns(
        {c: F.array("check").alias(c) for c in ("keys", "bits", "needed")}
    )
    renamed, nodes = jaccard_join._distinct_sets(sketches)
    node = {r.doc_id: r.node for r in renamed.collect()}
    assert (node[2], node[4], node[5]) == (7, 8, None)
    assert node[1] == node[3] != 7
    assert {(r.node, r["row"].doc_id, r["keys"][0]) for r in nodes.collect()} == {(7, 2, 40), (8, 4, 50), (node[1], 1, 50)}


def test_set_numbers_do_not_depend_on_order():
    hashes = next(jaccard_join.shingle_sets([" ".join(map(str, range(200)))]))
    assert jaccard_join.signature(hashes) == jaccard_join.signature(hashes[::-1])
    assert len(set(jaccard_join.signature(hashes))) == 2
    assert not set(jaccard_join.signature(hashes)) & set(jaccard_join.signature(hashes[1:]))


def test_parity_bits_bound_the_difference():
    draw = np.random.default_rng(3)
    for n in (1, 30, 3000):
        a = np.unique(draw.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.r_[a[n // 5 :], draw.integers(0, 2**63, n // 7).astype(np.uint64)])
        differing = len(np.setxor1d(a, b))
        x, y = (jaccard_join.parity_bits(s).view(np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= differing


def test_marks_cover_all_that_is_wanted_and_little_else(spark, monkeypatch):
    """Rows without an id too, and with so few bits that all marks are taken."""
    doc_id = F.when(F.col("id") % 10 > 0, F.col("id")).alias("doc_id")
    rows = spark.range(20000).select("id", doc_id, F.xxhash64(F.col("id") % 15000).alias("text_hash"))
    wanted = rows.where("id % 100 IN (0, 1)").select("doc_id", "text_hash")
    for bits, most in ((24, 500), (6, 20000)):
        monkeypatch.setattr(jaccard_join, "MARK_BITS", bits)
        found = jaccard_join._marked(rows, wanted)
        assert found.columns == [*rows.columns, "marked"] and found.count() == 20000
        marked = {r.id for r in found.where("marked").collect()}
        assert {i for i in range(20000) if i % 100 < 2} <= marked and len(marked) <= most
        assert jaccard_join._marked(rows, wanted.limit(0)).where("marked").isEmpty()


def test_near_copies_sort_no_text_that_is_in_no_pair(spark, monkeypatch):
    """Only texts of sets that are compared, and of documents that go, meet others in a join."""
    made = {}

    def spied(df, name, write=jaccard_join.materialize):
        made[name] = df
        return write(df, name)

    monkeypatch.setattr(jaccard_join, "materialize", spied)
    words = [F.concat(F.lit(f"w{i}-"), F.expr("greatest(id - 1, 0)")) for i in range(30)]
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *words, F.col("id")).alias("text"))
    kept = jaccard_join.drop_near(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(2, 3000)]
    for df in (made["set-texts"], kept):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "rightHint=(strategy=broadcast)" in plan and "getbit" in plan


def test_near_copies_on_hard_rows(hard):
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.join_near(hard).collect())
    assert found == [(0, 2, 5), (1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 2, 5), (5, 2, 5), (6, 2, 5), (7, 1, 7), (8, 1, 8)]
    kept = jaccard_join.drop_near(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 5, 7, 8]
    assert jaccard_join.join_near(hard.limit(0)).count() == jaccard_join.drop_near(hard.limit(0)).count() == 0


def test_exact_copies_on_hard_rows(hard):
    found = exact_dedup.group_copies(hard).collect()
    empty = [r for r in found if r.doc_id in (1, 2, 3)]
    assert {(r.keep_id, r.group_size) for r in empty} == {(3, 3)}
    same = [r for r in found if r.keep_id == 5]
    assert sorted((r.doc_id or 0, r.kept) for r in same)[0] == (0, False)
    assert (len(same), sum(r.kept for r in same)) == (3, 1)
    kept = exact_dedup.drop_copies(hard)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7, 8]
    assert exact_dedup.group_copies(hard.limit(0)).count() == exact_dedup.drop_copies(hard.limit(0)).count() == 0


def test_frequent_copies_take_the_other_way_to_the_same_result(spark):
    rows = [(i, "hot" + " " * (i % 3)) for i in range(200)] + [(200 + i, f"t{i % 40}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.group_copies(docs).collect()}
    assert {found[i] for i in range(200)} == {(2, 200)}
    assert found[239] == (239, 2)
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == [2, *range(200, 240)]


def test_line_dedup_keeps_the_first_and_compares_bytes(spark, hard):
    block = "\n".join(f"line {i} of a passage" for i in range(40))
    docs = spark.createDataFrame(
        [(1, f"alpha\n{block}\nomega"), (2, f"{block}"), (3, f"beta\ngamma\n{block}\n"), (4, "alpha\nomega")],
        "doc_id long, text string",
    )
    found = {r.doc_id: r for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert found[1].removed_lines == 0
    assert (found[2].removed_lines, found[2].clean) == (40, "")
    assert (found[3].removed_lines, found[3].clean) == (40, "beta\ngamma\n")
    assert found[4].clean == "alpha\nomega"
    kept = line_dedup.remove_repeated_chunks(hard)
    assert kept.count() == 9
    assert kept.where("doc_id = 1 AND clean IS NULL AND n_lines = 0").count() == 1
    assert line_dedup.remove_repeated_chunks(hard.limit(0)).count() == 0


@pytest.mark.parametrize("length", [2, 3, 5, 10, 40])
def test_line_dedup_finds_passages_of_any_length(length, spark):
    """A passage between other lines goes but for its first place, and no line that occurs once goes."""
    draw, rows, planted = random.Random(length), [], {}
    for passage in range(20):
        lines = [f"passage {passage} line {i} {draw.random()}" for i in range(length)]
        for copy in range(3):
            doc_id = 3 * passage + copy
            own = [f"own {doc_id} {i}" for i in range(6)]
            at = draw.randint(0, 6)
            rows.append((doc_id, "\n".join(own[:at] + lines + own[at:])))
            planted[doc_id] = (len(lines) if copy else 0, "\n".join(own) if copy else rows[-1][1])
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = line_dedup.remove_repeated_chunks(docs).collect()
    assert {r.doc_id: (r.removed_lines, r.clean) for r in found} == planted


def test_line_dedup_of_blank_lines_and_runs(spark):
    rows = [
        (1, "a\n\nb\n\n\nc"),
        (2, "x\na\n \t\nb\n\ny\n\n\n"),
        (3, "z\nz\nz\nz\nw"),
        (4, "\n\n\n\n"),
        (5, "single"),
        (6, "single"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.clean for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert found == {1: rows[0][1], 2: "x\n\ny\n\n\n", 3: "z\nw", 4: rows[3][1], 5: "single", 6: "single"}


def test_line_dedup_compares_bytes_where_hashes_meet(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_digest", lambda value: F.md5(F.substring(value, 1, 1).cast("binary")))
    rows = [(1, "aq\nar"), (2, "aq\nar"), (3, "1x\n1y"), (4, "1x\n1y"), (5, "1z\n1w"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.removed_lines for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert found == {1: 0, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0}


def test_line_dedup_of_one_document_of_many_lines(spark):
    text = "\n".join(["head", "tail"] * 100_000)
    docs = spark.createDataFrame([(1, text), (2, "head\ntail\nend")], "doc_id long, text string")
    found = {r.doc_id: (r.removed_lines, r.clean) for r in line_dedup.remove_repeated_chunks(docs).collect()}
    assert found == {1: (199_998, "head\ntail"), 2: (2, "end")}


# --- search and URLs --------------------------------------------------------------------


def test_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES", 7)
    monkeypatch.setattr(topk_search, "QUERIES", 2)
    draw = random.Random(4)
    rows = [(i, [draw.choice((0.0, 0.1, -0.3, 0.25)) for _ in range(draw.randint(0, 5))]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = topk_search.search(vectors, F.col("vec_id") % 20 == 0, k=5).collect()
    weights = {i: [int(np.floor(64 * float(np.float32(x)))) for x in v] for i, v in rows}
    for query in (0, 20, 40):
        scores = {i: sum(a * b for a, b in zip(weights[query], w)) for i, w in weights.items() if i != query}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        got = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [(r.vec_id, r.score) for r in got] == [(i, scores[i]) for i in best]


def test_search_on_hard_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, []), (2, None), (3, [float("nan")]), (None, [1.0]), (4, [-1.0])]
    vectors = spark.createDataFrame([*rows, (20, [0.5, None])], "vec_id long, embedding array<float>")
    found = topk_search.search(vectors, F.col("vec_id") % 20 == 0).collect()
    one = [(0, 20480), (1, 0), (4, -4096)]
    assert sorted((r.vec_id, r.score) for r in found) == sorted(one * 2)
    assert topk_search.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_search_passes_over_other_columns(spark):
    rows = [(i, [float(i), 1.0]) for i in range(5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    names = ("rank", "score", "weights", "row_id", "query_id", "is_query", "queries", "candidates", "queries_block")
    more = vectors.withColumns({name: F.lit("x") for name in names})
    wanted = F.col("vec_id") == 0
    assert sorted(topk_search.search(more, wanted).collect()) == sorted(topk_search.search(vectors, wanted).collect())
    assert topk_search.search(more, wanted).count() == 4


def test_search_takes_every_finite_vector(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0**30, -(2.0**22)]), (2, [2.0**50, 0.0]), (3, [0.0, 2.0**25 + 4]), (5, [-(2.0**60), 0.0])]
    rows += [(20, [2.0**21, 2.0**21 + 0.25]), (40, [0.0, 2.0**25]), (60, [float("inf"), 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.search(vectors, F.col("vec_id").isin(0, 40, 60), k=4).collect()
    weights = {i: [int(64 * x) for x in v] for i, v in rows if i != 60}
    for query in (0, 40):
        scores = {i: sum(a * b for a, b in zip(weights[query], w)) for i, w in weights.items() if i != query}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:4]
        got = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [(r.vec_id, r.score) for r in got] == [(i, scores[i]) for i in best]
    assert {r.query_id for r in found} == {0, 40}
    for query, k in ((2, 4), (0, 7)):
        with pytest.raises(Exception, match="64-bit"):
            topk_search.search(vectors, F.col("vec_id") == query, k=k).collect()


URLS = [
    ("http://A.example.NET/en/x?login", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://a.net/?q=http://z.org/fr/", "a.net", "/", "net/", "block"),
    ("x://netnet", "netnet", "", None, "allow"),
    ("http://b.org/fr/", "b.org", "/fr/", "org/fr/", "allow"),
    ("http://example.com/de/a#b", "example.com", "/de/a", "example.com/de/", "block"),
    ("http://x.y/login", "x.y", "/login", "^login^", "block"),
    ("http://x.y/logins", "x.y", "/logins", None, "allow"),
    ("http://x.y/help/login/", "x.y", "/help/login/", "^help^login^", "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


@pytest.mark.parametrize("inline", [url_filter.INLINE_RULES, 0])
def test_urls(inline, spark, monkeypatch):
    monkeypatch.setattr(url_filter, "INLINE_RULES", inline)
    pages = spark.createDataFrame([(u, i) for i, (u, *_) in enumerate(URLS)], "url string, verdict int")
    found = {r.url: tuple(r)[1:] for r in url_filter.judge_urls(pages).collect()}
    assert found == {u: tuple(rest) for u, *rest in URLS}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, ()).collect()} == {"allow"}


@pytest.mark.parametrize("inline", [url_filter.INLINE_RULES, 0])
def test_urls_with_clashing_columns_and_of_great_length(inline, spark, monkeypatch):
    monkeypatch.setattr(url_filter, "INLINE_RULES", inline)
    names = ["__host", "__path", "__rest", "__host_path", "__host_rest", "__tokens", "__rule", "__page", "token", "a.b"]
    rows = [("http://a.net/" + "x/" * 200_000, 1), ("http://x.y/" + "q" * 400_000 + "/login", 2), (None, 3)]
    pages = spark.createDataFrame(rows, "url string, page_id long").withColumns({n: F.lit(n) for n in names})
    found = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert all([r[name] for name in names] == names for r in found.values())
    assert [found[i].verdict for i in (1, 2, 3)] == ["block", "block", "allow"]
    assert [found[i].rule for i in (1, 2, 3)] == ["net/", "^login^", None]
    assert [found[i].url for i in (1, 2, 3)] == [url for url, _ in rows]


def test_rules_are_indexed_by_their_rarest_token():
    rules = (url_filter.path_rule("block", "example.net/en/"), url_filter.Rule("r", "*x*", "block", 1))
    index = url_filter.index_rules(rules, {"example": 90, "net": 40, "en": 3})
    assert [token for token, _ in index] == ["en", ""]


# --- secrets and languages --------------------------------------------------------------

BASE = {
    "assign": (re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def plain_spans(text):
    spans = [(m.start(), k, kind, m.end()) for k, (kind, (p, ok)) in enumerate(BASE.items()) for m in p.finditer(text) if ok(m)]
    return [(start, end, kind) for start, _, kind, end in sorted(spans)]


def test_base_spans(texts):
    draw = random.Random(5)
    bits = ["password", "API_KEY", "tok", "token", "ſecret", "=", ":", " ", '"', "a1f", "AKIA", "Z9" * 9, "0f" * 13, "é", "x"]
    some = ["".join(draw.choices(bits, k=draw.randint(1, 12))) for _ in range(20000)]
    for text in [*some, *texts.values()]:
        assert secret_scan.base_spans(text) == plain_spans(text)


def test_secret_query(spark, sf_small, texts):
    for row in secret_scan.query(spark, sf_small).collect():
        spans = plain_spans(texts[row.doc_id])
        joined = ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        # Spans that the tests of randomness add stand between these.
        base = [s for s in row.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert ",".join(base) == joined
        counts = Counter(kind for _, _, kind in spans)
        assert (row.n_assign, row.n_access, row.n_hex) == (counts["assign"], counts["access"], counts["hex"])


def test_random_keys_are_found_and_words_are_not(spark):
    draw = random.Random(6)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = [(i, f"see {''.join(draw.choices(alphabet, k=40))} there") for i in range(40)]
    rows += [(100 + i, "z" * 30 + " einstaueinkeitlichlich abcdefghijklmnopqrstuvwxyz0123456789") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert sum(len(found[i].spans) == 1 for i in range(40)) >= 38
    assert not any(found[100 + i].spans for i in range(40))
    assert found[0].redacted == "see [SECRET] there"


def test_random_keys_after_names_are_found(spark):
    draw = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    forms = [("aws_key=", letters + "+/", ""), ("db_pass=", letters, ""), ("x/y?sig=", letters + "-_", "")]
    forms += [("my_own-", letters + "+/", "=="), ("in/a+b/", letters + "-_", "="), ("a=b&k=", letters, "=")]
    rows, keys = [], {}
    for i in range(180):
        before, alphabet, padding = forms[i % 6]
        keys[i] = "".join(draw.choices(alphabet, k=43))
        rows.append((i, f"see {before}{keys[i]}{padding} there"))
    rows += [(200, "=" * 40 + " " + "x" + "=" * 40 + " " + "-" * 40 + " " + "/_" * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    for form in range(6):
        assert sum(keys[i] not in found[i].redacted for i in range(form, 180, 6)) >= 28
    assert not found[200].spans


def test_redacted_documents_keep_their_columns(spark, hard):
    rows = [(1, "my password=abc123def \u00e9", 24), (2, None, None), (3, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: tuple(r)[1:] for r in secret_scan.redact_documents(docs).collect()}
    assert found == {1: ("my [SECRET] \u00e9", 13), 2: (None, None), 3: ("", 0)}
    assert secret_scan.redact_documents(hard).columns == hard.columns
    assert secret_scan.redact_documents(hard).count() == 9
    assert secret_scan.scan(hard.limit(0)).count() == 0


def test_languages_held_out(spark, sf_medium):
    docs = spark.read.parquet(f"{sf_medium}/documents.parquet")
    found = language_id.query(spark, sf_medium).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r.held_out]
    assert {r.held_out for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2} == {True}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_languages_on_hard_rows(spark, sf_small, hard):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = language_id.fit_on_documents(docs)
    found = {(r.doc_id, r.n_chars): r.lang_pred for r in language_id.identify(hard, model).collect()}
    assert {k[0] for k, v in found.items() if v == "und"} == {1, 2, 3, 8}
    kept = language_id.drop_undetermined(hard, model)
    assert kept.columns == hard.columns and kept.count() == 5
    none = language_id.fit(hard.where("false"))
    assert none.languages == [] and language_id.drop_undetermined(hard, none).count() == 5
    assert language_id.fit(hard.where("lang = 'fr'")).predict("mot")[0] == "fr"
    assert language_id.identify(hard.limit(0), model).count() == 0


def test_copies_do_not_crowd_out_a_language(spark, monkeypatch):
    """A text of very many copies, drawn or not, leaves the other texts of its language in the sample."""
    sizes, buckets, made = [], language_id.BUCKETS, language_id.pd.DataFrame

    def sizes_of_group(rows):
        weights = [float(rows["first"].sum()), float((~rows["first"]).sum())] + [0.0] * (buckets - 1)
        return made({"machine": [rows["machine"].iloc[0]], "weights": [weights]})

    monkeypatch.setattr(language_id, "_train_group", sizes_of_group)
    for seed in range(4):
        hot = spark.range(20000).select(F.lit(f"hot {seed}").alias("text"), F.lit("en").alias("lang"))
        rows = [(f"text {seed} {lang} {i}", lang) for lang in ("en", "de") for i in range(30)]
        model = language_id.fit(hot.union(spark.createDataFrame(rows, "text string, lang string")), sample=20)
        sizes.append(model.weights[0, :2].tolist())
    assert sizes == [[20.0, 20.0]] * 4


def test_families_are_told_apart_first():
    assert sorted(language_id.machines_of(["en", "de", "fr", "xx"])) == [
        ("family", "germanic", "only xx"),
        ("family", "germanic", "romance"),
        ("family", "only xx", "romance"),
        ("language", "de", "en"),
    ]
