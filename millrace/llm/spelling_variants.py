"""Grouping of spelling variants by a bit-sliced position index.

Two words are near when one inserted, deleted or replaced code point turns one into the other.
Within a block of words, an index holds one bitset per (position, letter): bit i is set when word
i has that letter there. A word is looked up with a few operations on whole bitsets per letter:
the set of words equal so far, the set with one letter replaced (same position) and the set with
one letter more (next position) advance together, 64 words per machine word.

Blocks are found without comparing everything. Let m be the length of the shorter word of a near
pair. The difference lies in the middle part of it, at first the whole word; cut in two, the pair
agrees on the first half or on the second one. Words of m and m + 1 letters that agree on a half
form a group. A group of more than `GROUP` words is cut again the same way, so that its words
agree on three quarters, and so on down to a single letter, where a group holds at most what the
alphabet allows. So any pair meets in a group of bounded size, however many words share a prefix.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A group with more words is divided further; groups are put together to blocks of about BLOCK words.
GROUP = 512
BLOCK = 2048


class PositionIndex:
    """One bitset per (position, letter) over a list of words, and one per length."""

    def __init__(self, words: list[str]):
        self.words = words
        self.letters: list[dict[str, int]] = [{} for _ in range(max(map(len, words), default=0))]
        self.lengths: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.lengths[len(word)] = self.lengths.get(len(word), 0) | bit
            for held, letter in zip(self.letters, word):
                held[letter] = held.get(letter, 0) | bit

    def near(self, word: str) -> list[int]:
        """Positions of the words that replace one letter of `word` or have one more.

        A word with one letter less is found from its own side.
        """
        same_length = self.lengths.get(len(word), 0)
        longer = self.lengths.get(len(word) + 1, 0)
        equal, replaced, added = same_length | longer, 0, 0
        none: dict[str, int] = {}
        for i, letter in enumerate(word):
            here = self.letters[i].get(letter, 0)
            after = (self.letters[i + 1] if i + 1 < len(self.letters) else none).get(letter, 0)
            added = (added | equal) & after
            replaced = replaced & here | equal & ~here
            equal &= here
            if not (equal or replaced or added):
                return []
        found = replaced & same_length | (added | equal) & longer
        out = []
        while found:
            low = found & -found
            out.append(low.bit_length() - 1)
            found ^= low
        return out


def near_pairs(words: list[str], queries: set[str]) -> Iterator[tuple[int, int]]:
    """(i, j) of near words of a block, i a query that is not longer than j."""
    index = PositionIndex(words)
    for i, word in enumerate(words):
        if word in queries:
            for j in index.near(word):
                yield i, j


# --- routing of words to groups -----------------------------------------------------------


def _group_key() -> Column:
    """Equal for words that agree outside the middle; other words with the same hash do no harm."""
    return F.xxhash64("m", "a", "b", F.left("word", F.col("a")), F.right("word", F.col("b")))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of its middle agreed on, and with the second one."""
    middle = F.col("m") - F.col("a") - F.col("b")
    half = F.floor(middle / 2).cast("int")
    cuts = F.array(
        F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b")),
        F.struct(F.col("a").alias("a"), (F.col("b") + middle - half).alias("b")),
    )
    return (
        rows.withColumn("cut", F.explode(cuts))
        .select("word", "n", "m", F.col("cut.a").alias("a"), F.col("cut.b").alias("b"))
        .withColumn("key", _group_key())
    )


def _with_sizes(rows: DataFrame) -> DataFrame:
    """Rows of groups that hold a pair, with the number of words of their group.

    The sizes are grouped by one expression more than the join needs, so that both sides of the
    join are plain shuffles and a hot key can be split.
    """
    queries = F.count_if(F.length("word") == F.col("m"))
    sizes = (
        rows.groupBy(F.hash("key").alias("spread"), "key")
        .agg(F.count("*").alias("size"), queries.alias("queries"))
        .where("size > 1 AND queries > 0")
        .select("key", "size")
    )
    return rows.join(sizes, "key")


def _grouped(words: DataFrame, group: int) -> list[DataFrame]:
    """Rows (key, word, n, m) of the groups of at most `group` words, from all rounds of cutting."""
    length = F.length("word")
    start = words.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("b")
    )
    rows, done = start.where("m > 0"), []
    while True:
        sized = materialize(_with_sizes(_halved(rows)), "variant-groups")
        large = (F.col("size") > group) & (F.col("m") - F.col("a") - F.col("b") > 1)
        done.append(sized.where(~large).select("key", "word", "n", "m"))
        rows = sized.where(large).select("word", "n", "m", "a", "b")
        if rows.isEmpty():
            return done


def _pairs_of_blocks(batches: Iterator[pd.DataFrame], block: int) -> Iterator[pd.DataFrame]:
    """Near words of a partition sorted by key; whole groups are collected up to a block."""

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(part["word"], part["n"]))
        words = list(counts)
        queries = set(part["word"][part["word"].str.len() == part["m"]])
        out = []
        for i, j in near_pairs(words, queries):
            one, other = words[i], words[j]
            out += [(one, other, counts[other]), (other, one, counts[one])]
        return pd.DataFrame(out, columns=["word", "near", "near_n"])

    held = pd.DataFrame()
    for batch in batches:
        held = pd.concat([held, batch], ignore_index=True) if len(held) else batch
        while len(held) > block:
            # The first group border at or after `block` rows; the last group may go on in the next batch.
            keys = held["key"].to_numpy()
            borders = (keys[block:] != keys[block - 1 : -1]).nonzero()[0]
            if not len(borders):
                break
            cut = block + int(borders[0])
            yield compared(held.iloc[:cut])
            held = held.iloc[cut:]
    if len(held):
        yield compared(held)


def near_words(words: DataFrame, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best) of the words with a near word; `best` is (near_n, near) of largest near_n.

    Ties go to the smallest near word in code-point order. `words` has distinct words and their
    counts n.
    """
    rows = None
    for part in _grouped(words, group):
        rows = part if rows is None else rows.unionByName(part)
    placed = rows.repartition("key").sortWithinPartitions("key")
    pairs = placed.mapInPandas(lambda b: _pairs_of_blocks(b, block), "word string, near string, near_n long")
    # A word has at most as many near words as letters can be changed in it.
    found = pairs.groupBy("word").agg(F.collect_set(F.struct((-F.col("near_n")).alias("less"), "near")).alias("found"))
    return found.select(
        "word",
        F.size("found").cast("long").alias("n_near"),
        F.array_min("found").alias("best"),
    ).select("word", "n_near", F.struct((-F.col("best.less")).alias("near_n"), F.col("best.near")).alias("best"))


# --- forms and roots ----------------------------------------------------------------------


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms are followed to the last, doubling each round.

    A form is more frequent than its word, so there are no circles.
    """
    roots = materialize(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        # The target side has one row per word; a root that many words share is split at run time.
        followed = materialize(
            roots.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "variant-roots",
        )
        roots = followed.select("word", "root")
        if followed.where("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, ratio: int = 10, group: int = GROUP) -> DataFrame:
    """Words with their form and root: (word, form, root, n, n_near, form_n).

    `words` holds word and n, each word once; null and empty words are left out, other columns are
    not read. A word's form is its near word of largest n (ties: the smallest in code-point order), if
    that n is at least `ratio` (above 1) times its own. The root is where forms lead to, the word
    itself without one. An empty table gives an empty result.
    """
    words = materialize(words.where("word <> ''").select("word", F.col("n").cast("long")), "variant-words")
    best = F.col("best")
    frequent = best["near_n"] >= ratio * F.col("n")
    judged = materialize(
        words.join(near_words(words, group), "word", "left").select(
            "word",
            F.when(frequent, best["near"]).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, best["near_n"]).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _roots(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def letter_runs(docs: DataFrame, id_column: str, text_column: str, min_length: int) -> DataFrame:
    """(id, run): the maximal runs of Latin letters of whole texts, A-Z in lower case, null texts none.

    Only runs of `min_length` and more letters; each occurrence is a row.
    """
    lowered = F.translate(F.col(text_column), UPPER, LOWER)
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    return docs.select(F.col(id_column).cast("string").alias("id"), F.explode(runs).alias("run"))


def misspelt(run: Column, doc_id: Column, one_in: int = 31) -> Column:
    """The run, without one letter where a checksum of id and run says so; a null id counts as empty."""
    drawn = F.crc32(F.concat(F.coalesce(doc_id, F.lit("")), F.lit(":"), run).cast("binary"))
    at = (drawn % F.length(run)).cast("int")
    shortened = F.concat(F.left(run, at), F.right(run, F.length(run) - at - 1))
    return F.when(drawn % one_in == 0, shortened).otherwise(run)


def word_counts(runs: DataFrame, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n) of the words of at least `min_length` letters that occur `min_count` times and more."""
    counted = runs.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    runs = letter_runs(docs, "doc_id", "text", 7)
    return group_variants(word_counts(runs.select(misspelt(F.col("run"), F.col("id")).alias("word"))))
