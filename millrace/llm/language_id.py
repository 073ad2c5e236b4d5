"""Language ID by hierarchical discrimination.

A text is described by the shares of its byte trigrams, hashed to `BUCKETS`. First its language
family is told, then its language within the family, each time by one-versus-one linear support
vector machines: for every two classes one machine, the class with the most support wins. So
closely related languages are only compared with each other.

Training takes at most `SAMPLE` distinct labelled texts per language, those of smallest hash, so
copies neither crowd out other texts nor add to them; each machine is trained in one task on the sample of its two classes. Prediction covers whole texts.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import materialize

UNDETERMINED = "und"
# Languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("ar", "he", "mt"),
}
# Distinct training texts of a language at most: the bound of what is learned from.
SAMPLE = 400
BUCKETS = 1 << 13
ROUNDS, COST = 30, 10.0
# Bytes described at a time.
BLOCK = 1 << 20


def family_of(language: str) -> str:
    return next((f for f, languages in FAMILIES.items() if language in languages), f"only {language}")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def buckets(text: str) -> Iterator[np.ndarray]:
    """The bucket of every byte trigram of the lower-cased text, in blocks."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    for start in range(0, len(data) - 2, BLOCK):
        part = data[start : start + BLOCK + 2].astype(np.uint32)
        first, second, third = part[:-2], part[1:-1], part[2:]
        mixed = first * np.uint32(0x9E3779B1) + second * np.uint32(0x85EBCA77) + third * np.uint32(0xC2B2AE3D)
        yield (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(19)


def features(text: str) -> np.ndarray:
    """Square roots of the trigram shares: a vector of length 1."""
    counts = np.zeros(BUCKETS)
    for part in buckets(text):
        counts += np.bincount(part, minlength=BUCKETS)
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, by dual coordinate descent.

    y is 1 or -1, weight scales the cost of a row. The last of the weights is the bias.
    """
    x = np.c_[x, np.ones(len(x), x.dtype)]
    w, dual = np.zeros(x.shape[1]), np.zeros(len(x))
    damping = 0.5 / (COST * weight)
    square = np.einsum("ij,ij->i", x, x) + damping
    order = np.random.default_rng(0)
    for _ in range(ROUNDS):
        for i in order.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1 + damping[i] * dual[i]
            new = max(dual[i] - slope / square[i], 0.0)
            if new != dual[i]:
                w += (new - dual[i]) * y[i] * x[i]
                dual[i] = new
    return w


def _train_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["language", "mark"], kind="stable")
    x = np.stack([features(t) for t in rows["text"]])
    y = np.where(rows["first"], 1.0, -1.0)
    share = np.where(y > 0, (y < 0).mean(), (y > 0).mean()) * 2
    w = train(x, y, np.maximum(share, 1e-3))
    return pd.DataFrame({"machine": [rows["machine"].iloc[0]], "weights": [w.tolist()]})


def machines_of(languages: list[str]) -> list[tuple[str, str, str]]:
    """(level, first, second): of any two families, and of any two languages in a family."""
    families: dict[str, list[str]] = {}
    for language in sorted(languages):
        families.setdefault(family_of(language), []).append(language)
    out = [("family", a, b) for a, b in combinations(sorted(families), 2)]
    return out + [("language", a, b) for group in families.values() for a, b in combinations(group, 2)]


class Model:
    """Languages, their machines, and the weights as one array; it travels to the workers."""

    def __init__(self, languages: list[str], weights: dict[int, list[float]]):
        self.languages = sorted(languages)
        self.machines = machines_of(languages)
        table = [weights[i] for i in range(len(self.machines))]
        self.weights = np.array(table, np.float32).reshape(len(table), BUCKETS + 1)

    def _winner(self, classes: list[str], level: str, margins: np.ndarray) -> tuple[str, float]:
        """The class with the most support, and its confidence against the closest other."""
        support = dict.fromkeys(classes, 0.0)
        least = dict.fromkeys(classes, 1.0)
        for (at, a, b), margin in zip(self.machines, margins, strict=True):
            if at == level and a in support and b in support:
                sure = float(1 / (1 + np.exp(-4 * np.clip(margin, -20, 20))))
                support[a], support[b] = support[a] + sure, support[b] + 1 - sure
                least[a], least[b] = min(least[a], sure), min(least[b], 1 - sure)
        best = max(classes, key=lambda c: (support[c], c))
        return best, least[best]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text)
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        families = sorted({family_of(x) for x in self.languages})
        family, sure = self._winner(families, "family", margins)
        inside = [x for x in self.languages if family_of(x) == family]
        language, surer = self._winner(inside, "language", margins)
        return language, sure * surer


def fit(labelled: DataFrame, text_column: str = "text", label_column: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the languages in `labelled`; rows without a label or a letter are left out.

    Per language the `sample` distinct texts of smallest hash are learned from, or all if there are
    fewer; copies count once. Two or more languages are needed to learn machines; one language gives
    a model that always names it.
    """
    usable = labelled.select(F.col(text_column).alias("text"), F.col(label_column).alias("language")).where(
        F.col("language").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    usable = usable.withColumn("mark", F.xxhash64("text"))
    marks = materialize(usable.select("language", "mark").distinct(), "text-marks")
    counts = {r["language"]: r["n"] for r in marks.groupBy("language").agg(F.count("*").alias("n")).collect()}
    machines = machines_of(list(counts))
    if not machines:
        return Model(list(counts), {})
    # Of many texts four times the sample stay, for the window to take its smallest from few: that
    # these are under the sample has no chance worth naming, that there are none is ruled out below.
    scale = 1 << 30
    shares = F.create_map(*[F.lit(v) for x, n in counts.items() for v in (x, min(scale, 4 * scale * sample // n + 1))])
    place = F.pmod("mark", F.lit(scale))
    few = marks.withColumn("place", place).where(F.col("place") < F.element_at(shares, F.col("language")))
    smallest = Window.partitionBy("language").orderBy("place", "mark")
    chosen = few.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= sample)
    # At most `sample` marks per language.
    chosen = materialize(chosen.select("language", "mark"), "chosen-marks")
    missing = set(counts) - {r["language"] for r in chosen.select("language").distinct().collect()}
    if missing:
        least = marks.where(F.col("language").isin(*missing)).groupBy("language").agg(F.min("mark").alias("mark"))
        chosen = chosen.union(least)
    drawn = usable.join(F.broadcast(chosen), ["language", "mark"]).groupBy("language", "mark")
    drawn = drawn.agg(F.min("text").alias("text"))
    sides = []
    for language in counts:
        for number, (level, a, b) in enumerate(machines):
            own = language if level == "language" else family_of(language)
            if own in (a, b):
                sides.append((language, number, own == a))
    table = labelled.sparkSession.createDataFrame(sides, "language string, machine int, first boolean")
    trained = (
        drawn.join(F.broadcast(table), "language")
        .groupBy("machine")
        .applyInPandas(_train_group, "machine int, weights array<double>")
    )
    # One row per machine: bounded by the number of languages, not of documents.
    return Model(list(counts), {r["machine"]: r["weights"] for r in trained.collect()})


def predict(text: Column, model: Model, once: bool = False) -> Column:
    """struct of lang_pred and score (0 to 1); a null text or one without a letter is `und`, 0.

    With `once`, Spark does not evaluate it again where a filter and a column use the result.
    """

    @F.pandas_udf("lang_pred string, score double")
    def languages(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return (languages.asNondeterministic() if once else languages)(text)


def identify(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, replacing columns of these names.

    One row out per row in, equal texts alike; only the text is looked at, all of it. An empty
    table gives an empty result; a model without languages answers `und`.
    """
    named = docs.withColumn("lang_pred", predict(F.col(text_column), model))
    return named.withColumns({"score": F.col("lang_pred.score"), "lang_pred": F.col("lang_pred.lang_pred")})


def drop_undetermined(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """`docs` without the rows that `predict` calls `und`: a null text, or one without a letter.

    A model that knows no language rejects the same rows and no others. Columns stay as they are.
    """
    if not model.languages:
        return docs.where(F.col(text_column).rlike(r"\p{L}"))
    rows = docs.select(F.struct("*").alias("document"), F.col(text_column).alias("text"))
    return identify(rows, model).where(F.col("lang_pred") != UNDETERMINED).select("document.*")


def settle_languages(
    docs: DataFrame, model: Model, text_column: str = "text", label_column: str = "lang"
) -> DataFrame:
    """`docs` without undetermined rows; the others without a language get the predicted one.

    A stated language is kept as it is, and so are the other columns. A model that knows no language
    rejects the same rows and names none.
    """
    if not model.languages:
        return drop_undetermined(docs, model, text_column)
    found = predict(F.col(text_column), model, once=True)
    named = docs.select(F.struct("*").alias("document"), found.alias("found"))
    named = named.where(F.col("found.lang_pred") != UNDETERMINED)
    language = F.coalesce(F.col("document")[label_column], F.col("found.lang_pred"))
    return named.select(*[(language if c == label_column else F.col("document")[c]).alias(c) for c in docs.columns])


def held_out(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out(F.col("doc_id"))))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit_on_documents(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
