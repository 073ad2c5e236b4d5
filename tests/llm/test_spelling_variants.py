"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import spelling_variants as sv


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :]


def brute(words, ratio=10):
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def brute_words(documents):
    counted = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counted[run] += 1
    return {w: n for w, n in counted.items() if n >= 2}


def found(spark, words, **options):
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    return sorted((tuple(r) for r in sv.group_variants(table, **options).collect()))


def test_query_equals_brute_force(spark, sf_small):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in sv.query(spark, sf_small).collect())
    expected = brute(brute_words(documents))
    assert got == expected
    assert any(r[1] for r in expected) and any(r[4] > 1 for r in expected)


@pytest.mark.parametrize("group", [4, 64])
def test_one_prefix_holds_most_words(spark, group):
    draw = random.Random(group)
    words = {"prefix" + "".join(draw.choices("abc", k=draw.randint(1, 5))): draw.randint(2, 500) for _ in range(250)}
    words |= {"".join(draw.choices("ab\u00e9", k=draw.randint(7, 9))): draw.randint(2, 500) for _ in range(150)}
    assert found(spark, words, group=group) == brute(words)


def test_blocks_smaller_than_a_partition(spark):
    draw = random.Random(5)
    words = {"".join(draw.choices("abcd", k=6)): draw.randint(2, 90) for _ in range(900)}
    near = sv.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), group=8, block=16)
    expected = {r[0]: r[4] for r in brute(words) if r[4]}
    assert {r.word: r.n_near for r in near.collect()} == expected


def test_forms_ties_and_chains(spark):
    words = {"aaaaaab": 2, "aaaaaac": 20, "aaaaaad": 20, "aaaaadd": 200, "aaaaddd": 1999, "zzzzzzz": 2}
    got = {r[0]: r[1:] for r in found(spark, words)}
    assert got["aaaaaab"] == ("aaaaaac", "aaaaaac", 2, 2, 20)
    assert got["aaaaaad"] == ("aaaaadd", "aaaaadd", 20, 3, 200)
    assert got["aaaaadd"][0] is None
    assert got["zzzzzzz"] == (None, "zzzzzzz", 2, 0, None)
    assert sorted((w, *v) for w, v in got.items()) == brute(words)
    long_chain = {"abcdefgh"[:7] + "x" * i: 2 * 10**i for i in range(12)}
    assert found(spark, long_chain) == brute(long_chain)


def test_short_and_very_long_words(spark):
    words = {"a": 5, "b": 50, "ab": 3, "x" * 20_000: 2, "x" * 19_999 + "y": 30, "x" * 20_001: 3}
    assert found(spark, words) == brute(words)


def test_hard_rows(spark):
    rows = [
        (1, None, "w"),
        (2, "", "w"),
        (None, "letters letters \u00c9cole\u00e0\u00e0", None),
        (3, "LETTERS let\u0142ters letters1letterz", "w"),
        (3, "LETTERS let\u0142ters letters1letterz", "w"),
        (4, "q" * 300_000, "w"),
        (5, "q" * 300_000 + " " + "word " * 50_000, "w"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").withColumns(
        {c: F.lit(1) for c in ("n", "key", "run", "form", "id", "size")}
    )
    runs = sv.letter_runs(docs, "doc_id", "text", 7)
    assert runs.count() == sum(len(re.findall("[A-Za-z\u00c0-\u00ff]{7,}", r[1] or "")) for r in rows)
    counted = sv.word_counts(runs.select(sv.misspelt(F.col("run"), F.col("id")).alias("word")))
    expected = brute_words([("" if r[0] is None else r[0], r[1]) for r in rows])
    assert {r.word: r.n for r in counted.collect()} == expected
    got = sorted(tuple(r) for r in sv.group_variants(counted).collect())
    assert got == brute(expected)
    assert sv.group_variants(counted.limit(0)).count() == 0
    extra = spark.createDataFrame([(None, 3, 1), ("", 3, 1), ("abcdefg", 3, 1)], "word string, n long, form long")
    assert [r.word for r in sv.group_variants(extra).collect()] == ["abcdefg"]
