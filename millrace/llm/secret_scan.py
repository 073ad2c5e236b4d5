"""Secret scan: fixed patterns, and a battery of randomness tests on what they leave.

Patterns find assignments, access keys and long hexadecimal runs. Any other long run of key-like
characters is tested; it ends after its padding, so a name before `=` is a run of its own, and one
with signs of both base64 alphabets is tested in parts of either. Its alphabet is inferred from its characters, and against a uniform draw
from that alphabet it takes a chi-squared test, a runs test and a serial-correlation test; a run
that fails one (a counter, an alphabet, a repeated word) is no random key. What passes gets a
p-value against ordinary text: under text the chi-squared statistic has a noncentrality that grows
with the length, so short runs need not be trusted and long ones may be. Within each length class
the runs of the whole corpus are then held to a false discovery rate (Benjamini-Hochberg), from
counts per class and p-value bin: the driver sees at most `CLASSES * BINS` counts.
"""

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
# A shorter first run of an access key or a hex run is dropped whole, so the lengths can be asked for.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# Key-like characters and their padding, of which base32 has up to six.
_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,6}")
_PARTS = (re.compile(r"[A-Za-z0-9+/]+=*"), re.compile(r"[A-Za-z0-9_-]+=*"))
SHORTEST = 20

# A truly random key is passed over with at most this chance, over the three tests together.
MISS = 0.001
# Share of wrong finds among the random spans of a length class.
FALSE_DISCOVERIES = 0.01
# Sum of squared letter shares in running text of European languages.
COINCIDENCE = 0.066
# Share of the letters a to f in such text: it seldom stays inside a hexadecimal alphabet.
HEX_LETTERS = 0.3
# Length classes are powers of two up to 2**CLASSES; p-value bins are tenths of a power of ten.
CLASSES, BINS = 24, 400

_ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("digits and lower case", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("digits and upper case", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("letters and digits", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64 of URLs", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
_LETTERS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def alphabet_of(run: str) -> str | None:
    """The smallest alphabet that holds the run; letters of one case are an alphabet as well."""
    used = set(run)
    for letters in _LETTERS:
        if used <= set(letters):
            return letters
    return next((a for _, a in _ALPHABETS if used <= set(a)), None)


def _below(z: float) -> float:
    """Chance of a standard normal value below z."""
    return math.erfc(-z / math.sqrt(2)) / 2


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared(values: list[int], size: int) -> float:
    counts: dict[int, int] = {}
    for v in values:
        counts[v] = counts.get(v, 0) + 1
    n = len(values)
    return sum(c * c for c in counts.values()) * size / n - n


def uniformity_p(values: list[int], size: int) -> float:
    """Two-sided, by the cube-root normal approximation of chi-squared."""
    freedom = size - 1
    spread = 2 / (9 * freedom)
    z = ((chi_squared(values, size) / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    return _two_sided(z)


def runs_p(values: list[int], size: int) -> float:
    """Wald-Wolfowitz runs of the lower and the upper half of the alphabet."""
    upper = [2 * v >= size for v in values]
    a = sum(upper)
    b = len(upper) - a
    if not a or not b:
        return 2.0 ** (1 - len(upper))
    runs = 1 + sum(x != y for x, y in zip(upper, upper[1:]))
    mean = 1 + 2 * a * b / (a + b)
    variance = (mean - 1) * (mean - 2) / (a + b - 1)
    return _two_sided((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_p(values: list[int], size: int) -> float:
    """Correlation of each symbol's place in the alphabet with the next one's."""
    n, mean = len(values), (size - 1) / 2
    moved = [v - mean for v in values]
    variance = (size * size - 1) / 12
    product = sum(x * y for x, y in zip(moved, moved[1:])) / (n - 1)
    return _two_sided(product / variance * math.sqrt(n - 1))


def text_p(values: list[int], size: int) -> float:
    """Chance that ordinary text of this length looks as even over the alphabet as this."""
    freedom = size - 1
    shift = len(values) * max(size * COINCIDENCE - 1, 0.0)
    z = (chi_squared(values, size) - freedom - shift) / math.sqrt(2 * (freedom + 2 * shift))
    return _below(z)


def battery(run: str) -> float:
    """p-value against ordinary text, or 1 if the run is not like a random one either."""
    run = run.rstrip("=")
    alphabet = alphabet_of(run)
    if not alphabet:
        return 1.0
    place = {c: i for i, c in enumerate(alphabet)}
    values, size = [place[c] for c in run], len(alphabet)
    tests = (uniformity_p, runs_p, serial_p)
    if min(test(values, size) for test in tests) < MISS / len(tests):
        return 1.0
    outside = HEX_LETTERS ** sum(map(str.isalpha, run)) if size == 16 else 1.0
    return text_p(values, size) * outside


def length_class(length: int) -> int:
    return min(length.bit_length(), CLASSES)


def p_bin(p: float) -> int:
    """Tenths of powers of ten below 1, rounded so that a bin's p-values are at most its own."""
    return BINS if p <= 10 ** (-BINS / 10) else int(-10 * math.log10(p))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; code points, end exclusive."""
    lower = text.lower()
    found = []
    if any(word in lower for word in _ASSIGN_WORDS):
        found = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def parts(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the long runs; one that mixes the base64 alphabets gives the parts of each."""
    for match in _RUN.finditer(text):
        start, end = match.span()
        if end - start < SHORTEST:
            continue
        run = match[0]
        if ("+" in run or "/" in run) and ("-" in run or "_" in run):
            found = {m.span() for pattern in _PARTS for m in pattern.finditer(run)}
            yield from sorted((start + s, start + e) for s, e in found if e - s >= SHORTEST)
        else:
            yield start, end


def candidates(text: str, base: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, float]]:
    """(start, end, p) of the long runs that no base span touches."""
    for start, end in parts(text):
        if all(end <= s or e <= start for s, e, _ in base):
            yield start, end, battery(text[start:end])


def redact(text: str, spans: list[tuple[int, int, str]], mask: str) -> str:
    """Each span, overlapping ones as one, replaced by the mask."""
    out, done = [], 0
    for start, end, _ in sorted(spans):
        if start >= done:
            out += [text[done:start], mask]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _tested(text: Column) -> Column:
    """array of (length class, p bin) of a text's tested runs."""

    @F.pandas_udf("array<struct<length:int,bin:int>>")
    def tested(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = (candidates(text, base_spans(text)) for text in (t or "" for t in texts))
            yield pd.Series([[(length_class(e - s), p_bin(p)) for s, e, p in runs] for runs in found])

    return tested(text)


def thresholds(docs: DataFrame, text_column: str = "text", rate: float = FALSE_DISCOVERIES) -> dict[int, int]:
    """Smallest accepted p-value bin per length class, from counts over all documents.

    Benjamini-Hochberg over the binned p-values of a class: the largest p with
    p <= rate * (runs at most p) / (runs). A class without such a p is absent.
    """
    runs = docs.select(F.explode(_tested(F.col(text_column))).alias("run")).groupBy("run.length", "run.bin")
    by_class: dict[int, dict[int, int]] = {}
    for row in runs.agg(F.count("*").alias("n")).collect():
        by_class.setdefault(row["length"], {})[row["bin"]] = row["n"]
    found = {}
    for length, bins in by_class.items():
        total, reached = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            reached += bins[b]
            if 10 ** (-b / 10) <= rate * reached / total:
                found[length] = b
    return found


def scan(docs: DataFrame, text_column: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`docs` with `spans` (array of kind, start, end) and `redacted` (the text without its secrets).

    Columns of these names are replaced. Base spans are kept as the patterns give them; random spans
    touch none of them, but may overlap where a run has parts in both base64 alphabets. A null text counts as empty: no spans, and a null redacted text. One row out
    per row in, repeated rows alike; an empty table gives an empty result.
    """
    accepted = thresholds(docs, text_column)

    @F.pandas_udf("spans array<struct<kind:string,start:int,end:int>>, changed string")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            all_spans, changed = [], []
            for text in texts:
                text = text or ""
                found = base_spans(text)
                for start, end, p in candidates(text, found) if accepted else ():
                    if p_bin(p) >= accepted.get(length_class(end - start), BINS + 1):
                        found = [*found, (start, end, "random")]
                found = sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
                all_spans.append([(kind, start, end) for start, end, kind in found])
                changed.append(redact(text, found, mask) if found else None)
            yield pd.DataFrame({"spans": all_spans, "changed": pd.Series(changed, dtype=object)})

    text = F.col(text_column)
    found = docs.withColumn("spans", spans(text))
    return found.withColumns(
        {"redacted": F.coalesce("spans.changed", text), "spans": F.col("spans.spans")}
    )


def redact_documents(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """All documents in their own columns, each secret replaced in the text; n_chars follows the text."""
    clean = scan(docs.select(F.struct("*").alias("document"), F.col(text_column).alias("text")))
    own = {c: F.col("document").getField(c) for c in docs.columns}
    changed = F.size("spans") > 0
    own[text_column] = F.col("redacted")
    if length_column in own:
        length = F.when(changed, F.length("redacted")).otherwise(own[length_column])
        own[length_column] = length.cast(docs.schema[length_column].dataType)
    return clean.select(*[c.alias(name) for name, c in own.items()])


def _joined(spans: Column) -> Column:
    texts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(texts, ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs)
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "random")

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )
