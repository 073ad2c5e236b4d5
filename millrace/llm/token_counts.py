"""Token counts by rank-synchronous merging over ragged arrays.

Many pre-tokens lie one after another in one array of symbols. In every round each pre-token finds
its lowest-ranked pair and all occurrences of that pair, left to right, are merged at once in all
pre-tokens; those without a mergeable pair are done and leave with their number of symbols. A
merge rank is never lower than the ranks of its parts, so this gives the same symbols as merging
one pair at a time.
"""

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.byte_bpe import WHITE

VOCABULARY = "byte_bpe_50k.json"
# Bytes merged at a time, and stretches of text whose counts a worker remembers.
BLOCK, REMEMBERED = 1 << 21, 250_000
_NONE = np.int32(2**31 - 1)
# White space and what follows it: where one ends the pattern ends a match as well.
_STRETCH = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Merge ranks of a vocabulary file as sorted arrays, and the counting of symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
        suffix = content["model"]["end_of_word_suffix"] or ""
        self.of_byte, self.of_last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for letter, byte in byte_letters().items():
            self.of_byte[byte], self.of_last[byte] = vocabulary[letter], vocabulary[letter + suffix]
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in merges]
        keys = np.array([(vocabulary[a] << 32) | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        added = [t["content"] for t in content["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.remembered: dict[str, int] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that non-empty words end with, one word after another, and their numbers."""
        counts, ended = np.zeros(len(words), np.int64), []
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol, last = self.of_byte[data], np.cumsum(lengths) - 1
        symbol[last] = self.of_last[data[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbol), _NONE)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self.rank(symbol[inside], symbol[inside + 1])
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(word)])
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == _NONE
            if done.any():
                counts[word[first[done]]] = size[done]
                keep = np.repeat(~done, size)
                ended.append((word[~keep], symbol[~keep]))
                symbol, word, rank = symbol[keep], word[keep], rank[keep]
                size, lowest = size[~done], lowest[~done]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, size))
            # In a run such as aaa the pairs overlap: every second one from the left is merged.
            starts = np.r_[True, (np.diff(hit) != 1) | (word[hit[1:]] != word[hit[:-1]])]
            run = np.maximum.accumulate(np.where(starts, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbol[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]
            symbol, word, rank = symbol[keep], word[keep], rank[keep]
            changed = np.r_[at, at[at > 0] - 1]
            rank[changed] = _NONE
            changed = changed[changed + 1 < len(word)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self.rank(symbol[changed], symbol[changed + 1])
        owner, symbols = (np.concatenate(c) for c in zip(*ended, strict=True))
        return symbols[np.argsort(owner, kind="stable")], counts

    def _learn(self, stretches: list[str]) -> dict[str, int]:
        """Counts of stretches, their pre-tokens merged in blocks of bounded size."""
        found: dict[str, int] = {}
        names, words, owner, held = [], [], [], 0
        for stretch in stretches:
            # Letters after at most one space are one pre-token; the pattern splits all else.
            if (stretch[1:] if stretch[0] == " " else stretch).isalpha():
                words.append(stretch.encode())
                owner.append(len(names))
            else:
                pieces = [p.encode("utf-8", "surrogatepass") for p in _pattern().findall(stretch)]
                words += pieces
                owner += [len(names)] * len(pieces)
            names.append(stretch)
            held += len(stretch)
            if held > BLOCK:
                found |= self._totals(names, words, owner)
                names, words, owner, held = [], [], [], 0
        return found | self._totals(names, words, owner) if names else found

    def _totals(self, names: list[str], words: list[bytes], owner: list[int]) -> dict[str, int]:
        totals = np.bincount(owner, weights=self.merge(words)[1], minlength=len(names))
        return dict(zip(names, totals.astype(np.int64).tolist(), strict=True))

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; an added token's own string counts as one."""
        split = []
        for text in texts:
            parts = self.special.split(text) if text and self.special else [text or ""]
            split.append((len(parts) - 1, [s for p in parts for s in _STRETCH.findall(p)]))
        known = self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        new = set().union(*(stretches for _, stretches in split)).difference(known)
        known.update(self._learn(list(new)))
        return [specials + sum(map(known.__getitem__, stretches)) for specials, stretches in split]


@functools.cache
def _pattern():
    return regex.compile(public_tokenizers.PATTERN)


@functools.lru_cache(maxsize=4)
def merges_of(path: str) -> Merges:
    return Merges(path)


# Texts counted together in a worker.
TEXTS = 1000


def token_count(text: Column, path: str | None = None) -> Column:
    """Tokens of a text without begin or end tokens; null counts as empty."""
    path = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merges = merges_of(path)
        for texts in batches:
            rows = texts.tolist()
            parts = (merges.count(rows[i : i + TEXTS]) for i in range(0, len(rows), TEXTS))
            yield pd.Series([n for part in parts for n in part], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, limit: int = 512, path: str | None = None, text_column: str = "text") -> DataFrame:
    """`docs` with n_bytes, n_tokens and over_limit, replacing columns of these names.

    One row out per row in, repeated rows alike; a null or empty text counts 0; an empty table gives
    an empty result. Texts are counted whole, whatever their length.
    """
    text = F.col(text_column)
    counted = docs.withColumns(
        {
            "n_bytes": F.octet_length(F.coalesce(text, F.lit(""))).cast("long"),
            "n_tokens": token_count(text, path),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
