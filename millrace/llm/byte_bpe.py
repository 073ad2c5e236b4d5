"""Byte-level BPE encoding and decoding by a file of ranks.

`tiktoken` does the merges inside Python workers that Spark feeds with Arrow batches. A long text
is first cut where the pattern must end a match anyway: between a character that is no white
space and white space. So no call holds more than a stretch of it, and the ids are those of the
whole text. A very long run of white space, in which the library's own matching fails, is cut by the
pattern's rule for it: all but the last character is one match if anything follows, else all. Decoding gives raw bytes, since a token need not end between characters.
"""

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_multi_50k.tiktoken"
# Texts beyond so many characters are cut at the next safe boundary.
STRETCH = 1 << 16
# Rows of a batch that a worker hands back together.
ROWS = 256
# Unicode white space, as `\s` of the pattern has it.
_WIDE = (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WHITE = "\\t-\\r \\x85\\xa0" + "".join(map(chr, _WIDE))
# Runs of so much white space are matched here rather than by the library.
RUN = 10_000
_RUNS = re.compile(f"[{WHITE}]{{{RUN},}}")
_SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def stretches(text: str, length: int = STRETCH) -> Iterator[str]:
    """The text in order, cut at safe boundaries only; one piece if it has none."""
    start = 0
    while len(text) - start > length and (cut := _SAFE.search(text, start + length)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def ids_of(codec: tiktoken.Encoding, text: str) -> np.ndarray:
    parts, start = [], 0
    for run in _RUNS.finditer(text):
        # What comes before ends with no white space, so the pattern ends a match there.
        parts += [codec.encode_ordinary(part) for part in stretches(text[start : run.start()])]
        start = run.end() if run.end() == len(text) else run.end() - 1
        parts.append(codec._encode_single_piece(text[run.start() : start]))
    parts += [codec.encode_ordinary(part) for part in stretches(text[start:] if start else text)]
    return np.concatenate([np.array(part, np.int32) for part in parts])


def _few(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            yield batch.iloc[start : start + ROWS]


def encode(text: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """array<int> of the ids of a text; strings of special tokens are ordinary text, null is empty."""
    path = path or public_tokenizers.path(RANKS)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = encoding(path, pattern)
        for rows in _few(batches):
            yield pd.Series([ids_of(codec, text or "") for text in rows], dtype=object)

    return ids(text)


def decode(ids: Column, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Column:
    """binary: the bytes of the ids, not required to be whole characters; null is empty."""
    path = path or public_tokenizers.path(RANKS)

    @F.pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = encoding(path, pattern)
        for rows in _few(batches):
            made = [b"" if row is None else codec.decode_bytes(row.tolist()) for row in rows]
            yield pd.Series(made, dtype=object)

    return raw(ids)


def encode_documents(docs: DataFrame, path: str | None = None, text_column: str = "text") -> DataFrame:
    """`docs` with `ids` (array<int>) and `decoded` (binary), replacing columns of these names.

    One row out per row in, repeated rows alike; a null or empty text has no ids; an empty table
    gives an empty result. Texts are encoded whole, whatever their length.
    """
    encoded = docs.withColumn("ids", encode(F.col(text_column), path))
    return encoded.withColumn("decoded", decode(F.col("ids"), path))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
