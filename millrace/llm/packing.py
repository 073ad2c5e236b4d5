"""Packing documents into fixed-length sequences by cutting-stock column generation.

A document is cut only where it exceeds a sequence: into full pieces and a rest. Lengths of pieces
are counted per class of `STEP` tokens, short ones per token, a histogram of at most capacity / STEP + SHORT
numbers whatever the input. Over it, short pieces together as one class of a single step, a linear program chooses how often each pattern of classes is used; a knapsack by
dynamic programming prices new patterns by the program's duals until none improves it. Pattern
counts are rounded down, and the few pieces left are filled into further patterns the same way. Short pieces
are then poured by their true lengths into the room that patterns leave, the rest into sequences of their own.

Pieces then take slots by rank within their class. Ranks come in two levels, within hashed shards
and over the shards' sizes, so that no class is ordered in one task.
"""

import functools
import math
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from millrace.llm.token_counts import merges_of
from millrace.session import materialize

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END = 4096, 2
STEP = 16
# Pieces of at most so many tokens have a class for every length.
SHORT = 128
# Words whose ids a worker remembers, documents it takes together, and pieces it merges together.
REMEMBERED, ROWS, MERGED = 500_000, 1000, 100_000
# Pivots of the linear program at most; any basis met on the way is a valid, if looser, plan.
PIVOTS = 20_000
# It ends when no pattern is worth more than 1 + GAP: then it is within that share of the optimum.
GAP = 1e-3


# The split of the vocabulary file's own pre-tokenizer.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class Words:
    """Ids of texts, word by word: the vocabulary drops white space, so no token spans two words.

    New words are lower-cased and split here and merged all at once; words whose normal form
    depends on more than their letters one by one are left to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.merges = Tokenizer.from_file(path), merges_of(path)
        self.known: dict[bytes, bytes] = {}

    def _parts(self, word: bytes) -> list[bytes] | None:
        """The pre-tokens of a word in their normal form; None if only the library can tell."""
        text = word.decode()
        if "\u03a3" in text or self.merges.special.search(text) or not unicodedata.is_normalized("NFC", text):
            return None
        lower = text.lower()
        return [lower.encode()] if lower.isalpha() else [p.encode() for p in _PIECE.findall(lower)]

    def _learn(self, words: list[bytes]) -> None:
        # ASCII letters are one pre-token, with one sign after them two; isalpha() of bytes is ASCII's.
        letters = {word: word.lower() for word in words if word.isalpha()}
        signed = [w for w in words if w not in letters and w[-1] in b".,;:!?" and w[:-1].isalpha()]
        ended = {word: word[:-1].lower() for word in signed}
        split = {word: self._parts(word) for word in words if word not in letters and word not in ended}
        pieces = {*letters.values(), *ended.values(), *(w[-1:] for w in ended)}
        pieces = list(pieces.union(*(parts for parts in split.values() if parts)))
        found: dict[bytes, bytes] = {}
        for start in range(0, len(pieces), MERGED):
            some = pieces[start : start + MERGED]
            symbols, counts = self.merges.merge(some)
            data, ends = symbols.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            found.update({p: data[i:j] for p, i, j in zip(some, [0, *ends[:-1]], ends, strict=True)})
        self.known.update({word: found[piece] for word, piece in letters.items()})
        self.known.update({word: found[piece] + found[word[-1:]] for word, piece in ended.items()})
        for word, parts in split.items():
            if parts is None:
                ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
                self.known[word] = np.array(ids, "<u4").tobytes()
            else:
                self.known[word] = b"".join([found[p] for p in parts])

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [text.encode("utf-8", "replace").split() for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self._learn(list(set().union(*split).difference(self.known)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in split]


@functools.lru_cache(maxsize=4)
def words_of(path: str) -> Words:
    return Words(path)


PIECES = pa.schema(
    [("row_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
    + [("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)


def pieces(
    docs: DataFrame, path: str, capacity: int, end: int, with_ids: bool, id_column: str, text_column: str
) -> DataFrame:
    """One row per piece of each document: full sequences first, then the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held = words_of(path), []

        def hand_back():
            return pa.RecordBatch.from_pylist(held, schema=PIECES)

        for batch in batches:
            for first in range(0, len(batch), ROWS):
                rows = batch.slice(first, ROWS)
                row_ids, doc_ids, texts = (rows[n].to_pylist() for n in ("row_id", "doc_id", "text"))
                all_ids = codec.ids([text or "" for text in texts])
                for row_id, doc_id, ids in zip(row_ids, doc_ids, all_ids, strict=True):
                    ids = np.append(ids, np.array(end, "<u4"))
                    for start in range(0, len(ids), capacity):
                        part = ids[start : start + capacity]
                        values = (row_id, doc_id, start, len(part), zlib.crc32(part), len(ids))
                        held.append(dict(zip(PIECES.names, (*values, part if with_ids else None), strict=True)))
                yield hand_back()
                held = []

    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
    )
    schema = "row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
    return rows.mapInArrow(cut, schema)


def price(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within room (unbounded knapsack), and its counts."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        fits = np.searchsorted(sizes, c, "right")
        best[c] = best[c - 1]
        if fits:
            gains = values[:fits] + best[c - sizes[:fits]]
            i = int(gains.argmax())
            if gains[i] > best[c] + 1e-12:
                best[c], last[c] = gains[i], i
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[room]), counts


def solve(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per row) and how often each is used, a real number, to cover the demand.

    Revised simplex: the basis has one pattern per size; an entering pattern is priced by the
    knapsack and the inverse is updated by one pivot.
    """
    patterns = np.diag(room // sizes).astype(float)
    inverse = np.diag(1 / np.diag(patterns))
    used = inverse @ demand
    for _ in range(PIVOTS):
        value, column = price(inverse.sum(axis=0), sizes, room)
        if value <= 1 + GAP:
            break
        way = inverse @ column
        steps = np.where(way > 1e-9, used / np.where(way > 1e-9, way, 1), np.inf)
        out = int(steps.argmin())
        step = steps[out]
        used = np.maximum(used - step * way, 0)
        used[out] = step
        patterns[out] = column
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
    return patterns.astype(np.int64), used


def fullest(sizes: np.ndarray, left: np.ndarray, room: int) -> np.ndarray:
    """Counts of the pieces left that fill the room best, larger ones first."""
    counts, reach, items = np.zeros(len(sizes), np.int64), [1], []
    below = (1 << (room + 1)) - 1
    for i in range(len(sizes) - 1, -1, -1):
        for _ in range(min(int(left[i]), room // int(sizes[i]))):
            if reach[-1] >> room & 1:
                break
            items.append(i)
            reach.append(reach[-1] | (reach[-1] << int(sizes[i])) & below)
    at = reach[-1].bit_length() - 1
    for step in range(len(items), 0, -1):
        if not reach[step - 1] >> at & 1:
            counts[items[step - 1]] += 1
            at -= int(sizes[items[step - 1]])
    return counts


def fill(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Patterns for the pieces left: the largest first, the fullest completion, as often as it goes."""
    out, left = [], left.copy()
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        first = np.zeros(len(sizes), np.int64)
        first[top] = 1
        counts = first + fullest(sizes, left - first, room - int(sizes[top]))
        times = int((left[counts > 0] // counts[counts > 0]).min())
        out.append((counts, times))
        left -= counts * times
    return out


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pieces of each class, number of sequences) that hold exactly the counted pieces."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram))
    demand = np.array([histogram[s] for s in sizes], np.int64)
    patterns, used = solve(sizes, demand.astype(float), room)
    times = np.floor(used + 1e-9).astype(np.int64)
    # Rounding errors must not promise more pieces than there are.
    for i in range(len(times)):
        while times[i] and (demand - times @ patterns < 0).any():
            times[i] -= 1
    whole = [(p, int(n)) for p, n in zip(patterns, times, strict=True) if n]
    whole += fill(sizes, demand - times @ patterns, room)
    return [({int(s): int(c) for s, c in zip(sizes, p, strict=True) if c}, n) for p, n in whole]


def poured(
    patterns: list[tuple[dict[int, int], int]], shorts: dict[int, int], room: int, capacity: int
) -> list[tuple[dict[int, int], int]]:
    """The patterns with exactly the counted short pieces, by length, in their room and in further sequences.

    In a pattern, class 1 is room kept for short pieces, and classes from 2 on are steps of longer ones; a
    short piece's class is its length below zero.
    """
    lengths = np.array(sorted(shorts), np.int64)
    left, out = np.array([shorts[n] for n in lengths.tolist()], np.int64), []
    for counts, times in patterns:
        longer = {size: n for size, n in counts.items() if size > 1}
        space = min(STEP * (room - sum(size * n for size, n in longer.items())), capacity)
        while longer and times:
            some = fullest(lengths, left, space)
            fits = min(times, int((left[some > 0] // some[some > 0]).min())) if some.any() else times
            short = {-int(n): int(c) for n, c in zip(lengths, some, strict=True) if c}
            out.append(({**longer, **short}, fits))
            left -= some * fits
            times -= fits
    own = fill(lengths, left, capacity)
    return out + [({-int(s): int(c) for s, c in zip(lengths, p, strict=True) if c}, n) for p, n in own]


def slots(chosen: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first rank, rank after the last, pieces in a sequence, first sequence, first place)."""
    out, rank, sequence = [], {}, 0
    for counts, times in chosen:
        place = 0
        for size, count in sorted(counts.items(), reverse=True):
            first = rank.get(size, 0)
            rank[size] = first + count * times
            out.append((size, first, rank[size], count, sequence, place))
            place += count
        sequence += times
    return out


def _ranked(cut: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Each piece's rank in its class, from 0 without gaps.

    Shards hold about a quarter of the square root of all pieces, and there are about as many of
    them, so neither a shard nor the list of shards of a class is large.
    """
    size = max(50, math.isqrt(sum(histogram.values())) // 4)
    shards = F.create_map(*[F.lit(v) for c, n in histogram.items() for v in (c, -(-n // size))])
    shard = F.pmod(F.xxhash64("row_id", "start"), F.element_at(shards, F.col("class")))
    placed = cut.withColumn("shard", shard)
    within = Window.partitionBy("class", "shard").orderBy("row_id", "start")
    before = Window.partitionBy("class").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("class", "shard").agg(F.count("*").alias("n"))
    earlier = sizes.select("class", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = placed.withColumn("inside", F.row_number().over(within) - 1)
    return inside.join(earlier, ["class", "shard"]).withColumn("rank", F.col("inside") + F.col("earlier"))


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    with_ids: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every id of every document in exactly one piece, pieces in sequences of at most `capacity`.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for,
    ids. A document's ids end with `end`; a null or empty text is that id alone. Repeated rows are
    packed each on its own, their pieces told apart by sequence and offset. An empty table gives an
    empty result. Other columns are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    cut = pieces(docs, path, capacity, end, with_ids, id_column, text_column)
    cut = cut if with_ids else cut.drop("ids")
    # A piece that overhangs the last whole step has the last class: it fills a sequence alone.
    room = max(capacity // STEP, 1)
    steps = F.least(F.ceil(F.col("length") / STEP), F.lit(room))
    size = F.when(F.col("length") <= SHORT, -F.col("length")).otherwise(steps).cast("int")
    cut = materialize(cut.withColumn("class", size), "pieces")
    counts = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    shorts = {-size: n for size, n in counts.items() if size < 0}
    histogram = {size: n for size, n in counts.items() if size > 0}
    if histogram and shorts:
        histogram[1] = -(-sum(length * n for length, n in shorts.items()) // STEP)
    table = slots(poured(plan(histogram, room), shorts, room, capacity))
    kept = [c for c in cut.columns if c not in ("row_id", "class")]
    if not table:
        nowhere = F.lit(None).cast("long")
        return cut.select(*kept, nowhere.alias("sequence_id"), nowhere.alias("offset")).limit(0)
    names = "class int, first long, after long, copies long, sequence long, place long"
    # At most a few rows per pattern, and a few patterns per class: bounded by the capacity.
    assigned = F.broadcast(docs.sparkSession.createDataFrame(table, names))
    ranked = _ranked(cut, counts).alias("piece").join(
        assigned.alias("slot"),
        (F.col("piece.class") == F.col("slot.class"))
        & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("after")),
    )
    turn = F.col("rank") - F.col("first")
    seated = ranked.select(
        *kept,
        (F.col("sequence") + F.floor(turn / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("place") + turn % F.col("copies")).alias("seat"),
    )
    earlier = Window.partitionBy("sequence_id").orderBy("seat").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")
    return seated.select(*kept, "sequence_id", offset)


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_ids=False)
