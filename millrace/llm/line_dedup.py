"""Line dedup over content-defined chunks of lines.

Every line that is not blank is hashed, and a rolling hash over each `WINDOW` neighbouring ones, blank lines
left out of account, is the key of a chunk. Boundaries depend on those lines alone, so an inserted or deleted
line moves only the chunks it lies in. A sparser choice of boundaries loses short passages: one of two lines
is found only if just these two are a chunk. A boundary function of any rate and its complement together cut
after every line, and of their chunks the shortest do all the work: where a longer one repeats, so do the
chunks of two lines in it, at the same places. So these alone are kept, one per line.

Keys that occur more than once are counted first, without texts. Then the bytes of their chunks are
compared: equal hashes alone remove nothing. A chunk stays at its first place and is removed elsewhere; what
is removed of a document is the union of its chunks, so longer passages go as a whole.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

# Fixed for the query: lines in a chunk, and what makes a line more than blank.
WINDOW = 2
SOLID = r"[^\x20\x09-\x0D]"


def _digest(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def _lined(rows: DataFrame, text: Column) -> DataFrame:
    """`rows` with the text's `lines` and `at`, the places of those that are not blank."""
    rows = rows.withColumn("lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    return rows.withColumn("at", F.filter(places, lambda i: F.get("lines", i).rlike(SOLID)))


def _occurrences(named: DataFrame) -> DataFrame:
    """One row per chunk: its key, its document and its place, counted in lines that are not blank."""
    lined = _lined(named, F.col("text"))
    hashed = lined.withColumn("hashes", F.transform("at", lambda i: _digest(F.get("lines", i))))
    starts = F.slice("hashes", 1, F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))

    def key(start: Column, place: Column) -> Column:
        return F.unhex(_digest(F.concat(start, *[F.get("hashes", place + k) for k in range(1, WINDOW)])))

    return hashed.select("doc_id", "mark", F.posexplode(F.transform(starts, key)).alias("place", "key"))


def _marked(docs: DataFrame, occurrences: DataFrame, named: list[Column]) -> DataFrame:
    """Each document with `seen`: its chunks whose key occurs again, and whether each is the key's first.

    Keys are combined before the shuffle, so one of many documents is a few rows. The first occurrence is
    that of smallest id, then hash of the text, then place.
    """
    here = F.struct("doc_id", "mark", "place")
    counted = occurrences.groupBy("key").agg(F.count("*").alias("n"), F.min(here).alias("first"))
    repeated = materialize(counted.where("n > 1").select("key", "first"), "repeated-chunks")
    chunk = F.struct("place", "key", here.eqNullSafe(F.col("first")).alias("first"))
    # At most the chunks of one document in a list.
    seen = occurrences.join(repeated, "key").groupBy("doc_id", "mark").agg(F.collect_set(chunk).alias("seen"))
    own = docs.select(F.struct("*").alias("document"), *named)
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.mark") == F.col("s.mark"))
    marked = own.alias("d").join(seen.alias("s"), same, "left").select("document", "d.doc_id", "d.mark", "seen")
    return materialize(marked, "marked-documents")


def _ambiguous(marked: DataFrame, text: Column) -> DataFrame:
    """Keys that stand for different bytes."""
    lined = _lined(marked.where("seen IS NOT NULL").select("seen", text.alias("text")), F.col("text"))

    def with_bytes(chunk: Column) -> Column:
        lines = [F.get("lines", F.get("at", chunk["place"] + k)) for k in range(WINDOW)]
        return F.struct(chunk["key"].alias("key"), F.concat_ws("\n", *lines).alias("chunk"))

    chunks = lined.select(F.inline(F.transform("seen", with_bytes)))
    variants = chunks.groupBy("key").agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
    return materialize(variants.where("least <> greatest").select("key"), "ambiguous-keys")


def _without(marked: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """`marked` with the chunks of ambiguous keys taken out of `seen`."""
    seen = marked.select("doc_id", "mark", F.inline("seen")).join(ambiguous, "key", "left_anti")
    chunk = F.struct("place", "key", "first")
    seen = seen.groupBy("doc_id", "mark").agg(F.collect_set(chunk).alias("seen"))
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.mark") == F.col("s.mark"))
    return marked.drop("seen").alias("d").join(seen.alias("s"), same, "left").select("document", "seen")


def remove_repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with `n_lines`, `removed_lines`, `removed_chunks` and `clean`, the text that is left.

    A line goes if it lies in a repeated chunk that is not the chunk's first occurrence; blank lines within
    such a chunk go with it. So every removed line that is not blank still stands at an earlier place. A key
    that stands for different bytes removes nothing.

    Columns of these names are replaced, all others pass through. A null text stays null and has no
    lines; an empty text is one empty line. Rows that share id and text are one document: they lose
    the same chunks, and a first occurrence in them stays in each. An empty table gives an empty
    result. Lines end at line feeds; every other byte belongs to its line.
    """
    name = [F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("mark")]
    # Rows that share id and text have the same chunks, which are counted once.
    named = docs.select(*name, F.col(text_column).alias("text"))
    text = F.col("document").getField(text_column)
    marked = _marked(docs, _occurrences(named), name)
    ambiguous = _ambiguous(marked, text)
    # One yes or no; in practice there are none, and then documents need not be shuffled again.
    marked = marked if ambiguous.isEmpty() else _without(marked, ambiguous)
    gone = F.transform(F.filter("seen", lambda chunk: ~chunk["first"]), lambda chunk: chunk["place"])
    gone = F.array_distinct(F.coalesce(gone, F.array().cast("array<int>")))
    parted = _lined(marked.select("document", gone.alias("gone")), text)
    spans = F.transform("gone", lambda place: F.sequence(F.get("at", place), F.get("at", place + WINDOW - 1)))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    parted = parted.withColumn("kept", F.array_except(places, F.flatten(spans)))
    parted = parted.withColumn("left", F.transform("kept", lambda i: F.get("lines", i)))
    no_text = text.isNull()
    made = {
        "n_lines": F.when(no_text, 0).otherwise(F.size("lines")).cast("long"),
        "removed_lines": (F.size("lines") - F.size("kept")).cast("long"),
        "removed_chunks": F.size("gone").cast("long"),
        "clean": F.when(no_text, F.lit(None)).otherwise(F.array_join("left", "\n")),
    }
    kept = [F.col("document").getField(c).alias(c) for c in docs.columns if c not in made]
    return parted.select(*kept, *[c.alias(name) for name, c in made.items()])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_chunks(docs).select(
        "doc_id",
        "n_lines",
        "removed_lines",
        "removed_chunks",
        F.sha2(F.coalesce("clean", F.lit("")).cast("binary"), 256).alias("clean_sha256"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, i, split[i] AS line, regexp_matches(split[i], '[^\x20\x09-\x0D]') AS solid
  FROM (SELECT doc_id, split, unnest(generate_series(1, len(split))) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS split FROM documents WHERE text IS NOT NULL))
),
chunks AS (
  SELECT doc_id, i, lead(i) OVER place AS until, line || chr(10) || lead(line) OVER place AS chunk
  FROM lines WHERE solid WINDOW place AS (PARTITION BY doc_id ORDER BY i)
),
gone AS (
  SELECT doc_id, i, until FROM chunks WHERE chunk IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY doc_id, i) > 1
),
marked AS (
  SELECT l.doc_id, l.i, line, g.i IS NOT NULL AS starts,
         coalesce(max(until) OVER (PARTITION BY l.doc_id ORDER BY l.i), 0) >= l.i AS removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i
),
cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS removed_lines,
         count(*) FILTER (starts) AS removed_chunks,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT removed), '') AS clean
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(removed_lines, 0) AS removed_lines,
       coalesce(removed_chunks, 0) AS removed_chunks, sha256(coalesce(clean, '')) AS clean_sha256
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""
