"""Landing text files to bronze: every column text, plus lineage columns."""

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import vocab

CORRUPT = "_corrupt_record"
# Separators that a header is tried with when none is given.
SEPARATORS = (",", ";", "\t", "|")


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_options(multi_line: bool = False, sep: str = ",") -> dict:
    """Header row, empty field (quoted or not) NULL, spaces kept.

    A file with quoted line breaks needs `multi_line`, which makes each file one task. A file whose
    header differs from the first one's fails the read rather than shift its columns.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "sep": sep,
        "emptyValue": "",
        "nullValue": "",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def header_of(spark: SparkSession, path, columns=(), multi_line: bool = False, sep: str = ",") -> list:
    """Column names of the first file's header, which has to hold `columns`, in any order."""
    try:
        names = spark.read.options(**csv_options(multi_line, sep)).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Missing source file: {path}") from error
        raise
    held = {name.lower() for name in names}
    if missing := [c for c in columns if c.lower() not in held]:
        raise ValueError(f"{path}: columns {missing} are not in the header {names} (separator {sep!r})")
    return names


def separator_of(spark: SparkSession, path, columns, multi_line: bool = False) -> str:
    """The one separator with which the first file's header holds all the columns.

    Only header lines are read. None or several such separators are refused, rather than one picked.
    """
    fitting, headers = [], {}
    wanted = {c.lower() for c in columns}
    for sep in SEPARATORS:
        headers[sep] = header_of(spark, path, (), multi_line, sep)
        if wanted <= {name.lower() for name in headers[sep]}:
            fitting.append(sep)
    if len(fitting) != 1:
        raise ValueError(
            f"{path}: the header {headers[SEPARATORS[0]]} holds the columns {list(columns)} with "
            f"{'several separators' if fitting else 'none of the separators'} {fitting or list(SEPARATORS)}"
        )
    return fitting[0]


def read_text_csv(
    spark: SparkSession,
    path,
    columns=None,
    multi_line: bool = False,
    keep_corrupt: bool = False,
    sep: str | None = ",",
) -> DataFrame:
    """Scan CSV files as text; short rows are padded with NULL.

    Without a `sep`, it is found from the header and `columns`. The header names the columns. `columns` come first, in their order, then what else the file
    has. With `keep_corrupt`, rows whose field count differs from the header carry their raw line
    in `_corrupt_record`, so fields beyond the header stay visible.
    """
    if sep is None:
        sep = separator_of(spark, path, columns or (), multi_line)
    names = header_of(spark, path, columns or (), multi_line, sep)
    schema = text_schema([*names, CORRUPT] if keep_corrupt else names)
    df = spark.read.options(**csv_options(multi_line, sep)).schema(schema).csv(path)
    return df.select(*ordered(names, columns), *([CORRUPT] if keep_corrupt else []))


def ordered(names, columns) -> list:
    """The registered columns under their own names, then the others of the header."""
    columns = columns or ()
    known = {c.lower() for c in columns}
    return [*[F.col(f"`{c}`").alias(c) for c in columns], *[f"`{n}`" for n in names if n.lower() not in known]]


def uneven_lines(spark: SparkSession, source: str, path, **read_options) -> DataFrame:
    """(source_file, fields_read, raw_line) of lines with more or fewer fields than the header.

    `fields_read` counts the fields that have a value and a column.
    """
    df = read_text_csv(spark, path, vocab.SOURCE_COLUMNS[source], keep_corrupt=True, **read_options)
    return uneven(df, F.lit(vocab.SOURCE_FILES[source]))


def uneven(df: DataFrame, source_file) -> DataFrame:
    """The uneven lines of rows read with their raw line."""
    fields = [F.col(f"`{c}`") for c in df.columns if c not in (CORRUPT, *vocab.LINEAGE_COLUMNS)]
    filled = F.size(F.filter(F.array(*fields), lambda field: field.isNotNull()))
    return df.where(F.col(CORRUPT).isNotNull()).select(
        source_file.alias("source_file"), filled.alias("fields_read"), F.col(CORRUPT).alias("raw_line")
    )


def new_batch() -> tuple[str, str]:
    """A random batch id and the current UTC time as ISO text."""
    return str(uuid.uuid4()), datetime.now(timezone.utc).isoformat()


def with_lineage(df: DataFrame, ingested_at: str, batch_id: str, source_file: str | None = None):
    """Append lineage text. Without a `source_file`, each row names the file it came from."""
    name = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.select(
        "*",
        F.lit(ingested_at).alias("ingested_at"),
        name.alias("source_file"),
        F.lit(batch_id).alias("batch_id"),
    )


def land(
    spark: SparkSession,
    source: str,
    path,
    ingested_at: str,
    batch_id: str,
    source_file: str | None = None,
    **read_options,
) -> DataFrame:
    """One registered source as a bronze DataFrame. `path` is a file, folder or glob."""
    df = read_text_csv(spark, path, vocab.SOURCE_COLUMNS[source], **read_options)
    return with_lineage(df, ingested_at, batch_id, source_file)


def land_all(spark: SparkSession, folder: str, ingested_at: str, batch_id: str, **read_options) -> dict:
    """Every registered source found under its landing file name in the folder."""
    return {
        source: land(spark, source, f"{folder}/{name}", ingested_at, batch_id, name, **read_options)
        for source, name in vocab.SOURCE_FILES.items()
    }


def presence(spark: SparkSession, folder: str) -> DataFrame:
    """(source, source_file, present, files, bytes) of every registered source, before anything is read.

    A source is a file or a folder of files; names that start with `_` or `.` are none of its files.
    """
    rows = []
    for source, name in vocab.SOURCE_FILES.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        storage = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = storage.listStatus(path) if storage.exists(path) else []
        sizes = [f.getLen() for f in found if f.isFile() and f.getPath().getName()[0] not in "_."]
        rows.append((source, name, bool(sizes), len(sizes), sum(sizes)))
    return spark.createDataFrame(rows, "source string, source_file string, present boolean, files int, bytes bigint")


def require_present(found: DataFrame, folder: str) -> None:
    """Raise, naming every absent source, unless all are there."""
    # One row per registered source.
    if absent := [r["source_file"] for r in found.where("NOT present").orderBy("source_file").collect()]:
        raise FileNotFoundError(f"Missing source file: {', '.join(f'{folder}/{name}' for name in absent)}")
