"""CSV scans (S1, S2, S9) and missing-token normalisation (S3).

No schema inference anywhere: without a schema every column is text, which
keeps keys such as '015009' or '15E009' intact; with a schema the types are
the declared ones.  Columns are bound by their names in the header, files of a
folder whose headers differ are an error, and so is a row with more fields than
the header or with a quoted line break that the scan was not told about.  A row
with fewer fields is padded with NULL.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelens.schemas import NA_TOKENS
from carelens.utils import q, qcol, sql_str

CORRUPT_COL = "_corrupt_record"

# Header, comma, double quote; blanks inside fields are data, not padding.
_CSV_OPTS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "inferSchema": "false",
}


def _reader(spark: SparkSession, encoding: str, multi_line: bool):
    r = spark.read.options(**_CSV_OPTS).option("encoding", encoding).option("enforceSchema", "false")
    return r.option("multiLine", "true") if multi_line else r


def _text_scan(spark: SparkSession, path, encoding: str, multi_line: bool, options: dict | None = None, header: str | None = None):
    """Every column as text under its header name, and the raw text of rows whose number of fields is not the
    header's in ``_corrupt_record``.  Rows are judged whole: column pruning is off, so that no select changes it.
    ``header``: a file to take the names from, if not any."""
    first = re.sub(r"([\\\[\]{}*?])", r"\\\1", header) if header else path
    names = _reader(spark, encoding, multi_line).options(**(options or {})).csv(first).columns
    fields = [T.StructField(c, T.StringType()) for c in names] + [T.StructField(CORRUPT_COL, T.StringType())]
    df = (_reader(spark, encoding, multi_line).options(**(options or {})).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT_COL).option("columnPruning", "false")
          .schema(T.StructType(fields)).csv(path))
    return df, names


def _broken(n_cols: int, multi_line: bool):
    """SQL: a row with too many fields, or (in a line scan) with a quote that is not closed on its line."""
    raw = q(CORRUPT_COL)
    bare = f"regexp_replace({raw}, '\"([^\"]|\"\")*\"', '')"
    wide = f"length({bare}) - length(replace({bare}, ',', '')) >= {n_cols}"
    if multi_line:
        return f"({raw} IS NOT NULL AND {wide})"
    odd = f"(length({raw}) - length(replace({raw}, '\"', ''))) % 2 = 1"
    return f"({raw} IS NOT NULL AND ({wide} OR {odd}))"


def _as_struct(schema) -> T.StructType | None:
    if schema is None or isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def read_csv(spark: SparkSession, path, schema=None, encoding: str = "UTF-8",
             string_cols=None, columns=None, multi_line: bool = False) -> DataFrame:
    """CSV scan (S1/S2).

    * ``schema`` (StructType or DDL): declared types, never inferred; its
      columns are found by name, in whatever order the header has them.
    * ``string_cols`` without a schema: every column is text anyway; the
      argument documents intent and is checked against the header.
    * ``columns``: project early so the scan reads only what is needed.
    * ``multi_line``: quoted fields may hold line breaks (as pandas allows).
      Such a file cannot be split, so each file is one task; keep it off for
      extracts without embedded newlines, and land big extracts as many files.
    """
    df, names = _text_scan(spark, path, encoding, multi_line)
    st = _as_struct(schema)
    missing = [c for c in [*(string_cols or []), *(st.names if st else [])] if c not in names]
    if missing:
        raise ValueError(f"columns not in header: {missing}")
    broken = _broken(len(names), multi_line)
    message = "'malformed CSV row (too many fields, or a quoted line break without multi_line): '"
    df = df.filter(f"CASE WHEN {broken} THEN raise_error(concat({message}, {q(CORRUPT_COL)})) ELSE true END")
    typed = {f.name: f.dataType.simpleString() for f in st.fields} if st else {}
    keep = columns or (st.names if st else names)
    return df.selectExpr(*[f"CAST({q(c)} AS {typed[c]}) AS {q(c)}" if typed.get(c, "string") != "string" else q(c)
                           for c in keep])


#: Suffixes of compressed files whose end Spark's reader checks, and of those where a file that was cut reads like a whole one.
CHECKED, UNCHECKED = ("gz", "bz2", "deflate"), ("snappy", "lz4", "zst", "lzo")


def _files(spark: SparkSession, path) -> DataFrame:
    """(path, file): each file's name, and how ``_metadata.file_path`` says it."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("_metadata.file_path").alias("file")).where(~F.col("path").rlike("/[_.][^/]*$")))


def _named(error: Exception, files: dict[str, str]) -> str | None:
    """Which of the files an error of a scan is about."""
    found = re.search(r"FAILED_READ_FILE\S* Encountered error while reading file (.*?)\.\s+(?:SQLSTATE|File|It is)", str(error), re.S)
    plain = lambda name: re.sub(r"^(\w+):/+", r"\1:/", unquote(name))  # noqa: E731  file:///x and file:/x are one
    return next((p for p, f in files.items() if found and plain(found[1]) in (plain(f), plain(p))), None)


def unreadable_files(spark: SparkSession, path, unchecked: str = "raise") -> DataFrame:
    """(path) of the compressed files below ``path`` that cannot be read to their end.

    Spark reads the files itself, line by line, so whatever the codec and however large a file is, a task holds a line of
    it.  A scan that fails names a file; that one is listed, and the others are scanned again in two halves, so that b bad
    files cost log2(b) + 2 passes at most.  Any other error is raised.  Only file names come to the driver.

    Cut files of some codecs (``UNCHECKED``) read without an error: they raise a ValueError, or are listed as unreadable
    (``unchecked="list"``).
    """
    suffix = F.regexp_extract("path", r"\.([^./]+)$", 1)
    files = _files(spark, path)
    odd = [r["file"] for r in files.where(suffix.isin(*UNCHECKED)).select("file").collect()]
    if odd and unchecked != "list":
        raise ValueError(f"{len(odd)} files of a codec that hides a missing end, such as {odd[0]}")
    names = {r["path"]: r["file"] for r in files.where(suffix.isin(*CHECKED)).collect()}
    failed, todo = [], [sorted(names)]
    while todo:
        some = todo.pop()
        if not some:
            continue
        exact = [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in some]
        try:
            spark.read.options(ignoreCorruptFiles="false", ignoreMissingFiles="false").text(exact).count()
        except (Py4JJavaError, PySparkException) as e:
            bad = _named(e, {p: names[p] for p in some})
            if bad is None:
                raise
            failed.append(names[bad])
            rest = [p for p in some if p != bad]
            todo += [rest[: len(rest) // 2], rest[len(rest) // 2 :]]
    return spark.createDataFrame([(f,) for f in sorted([*failed, *odd])], "path string")


def read_csv_tolerant(spark: SparkSession, path, schema, encoding: str = "UTF-8", unchecked: str = "raise"):
    """Tolerant typed scan (S9): bad items are reported and skipped.

    Returns ``(good, bad, failed)``.  A row is good when it has the header's
    number of fields and every typed field parses, whatever columns are
    selected later; ``bad`` keeps the fields as text and the raw row, where its
    number of fields is wrong, in ``_corrupt_record``.  ``failed`` lists files
    that cannot be read to their end (see :func:`unreadable_files`); they are
    not opened again, and no row of theirs is in either frame.  A read error in
    any other file is an error of the scan.
    """
    st = _as_struct(schema)
    failed = unreadable_files(spark, path, unchecked)
    gone = [r["path"] for r in failed.collect()]
    header = _files(spark, path).where(~F.col("file").isin(gone)).agg(F.min("path").alias("p")).first()["p"] if gone else None
    df, names = _text_scan(spark, path, encoding, False, {"ignoreCorruptFiles": "false", "recursiveFileLookup": "true"}, header)
    missing = [c for c in st.names if c not in names]
    if missing:
        raise ValueError(f"columns not in header: {missing}")
    whole = df.where(~F.col("_metadata.file_path").isin(gone)) if gone else df  # files are left out before they are opened
    typed = [f for f in st.fields if not isinstance(f.dataType, T.StringType)]
    parsed = [f"({q(f.name)} IS NULL OR try_cast({q(f.name)} AS {f.dataType.simpleString()}) IS NOT NULL)" for f in typed]
    ok = F.expr(" AND ".join([f"{q(CORRUPT_COL)} IS NULL", *parsed]))
    good = whole.filter(ok).selectExpr(*[f"try_cast({q(f.name)} AS {f.dataType.simpleString()}) AS {q(f.name)}"
                                         if f in typed else q(f.name) for f in st.fields])
    bad = whole.filter(~F.coalesce(ok, F.lit(False))).select(*[qcol(c) for c in [*st.names, CORRUPT_COL]])
    return good, bad, failed


def normalize_missing(df: DataFrame, tokens=NA_TOKENS, cols=None, keep=None) -> DataFrame:
    """Text equal to one of ``tokens`` becomes NULL (S3), text columns only.

    ``keep``: output only these columns, in this order (a retention folded
    into the same projection).  Built as one ``selectExpr``; Catalyst turns
    each ``IN`` list into a hash-set probe.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    text_cols = [c for c, t in types.items() if isinstance(t, T.StringType)]
    targets = set(c for c in (cols or text_cols) if c in text_cols)
    out_cols = list(keep) if keep is not None else df.columns
    if not targets and keep is None:
        return df
    toks = ", ".join(sql_str(t) for t in tokens)
    exprs = [f"CASE WHEN {q(c)} IN ({toks}) THEN NULL ELSE {q(c)} END AS {q(c)}" if c in targets else q(c)
             for c in out_cols]
    return df.selectExpr(*exprs)
