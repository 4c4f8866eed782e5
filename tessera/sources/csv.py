"""CSV sources (SRC-2 .. SRC-5).

SRC-2: delimited file with a header, explicit schema (no inference pass).
SRC-3: unknown encoding / separator. Spark reads the raw lines itself; the
       encoding is decided over the whole input by ``count_if(!is_valid_utf8)``
       (a distributed pass, no driver-side parsing), the separator from the
       header line. Then the file is read with an all-text schema.
SRC-4/5: typed projection of the text columns (see operators.clean).
"""

from __future__ import annotations

import logging
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.operators.clean import typed_projection
from tessera.sources.csv_lines import parse_records, quoted_lines, records, stray_quotes

log = logging.getLogger(__name__)

CANDIDATE_SEPARATORS = (";", ",", "\t", "|")


def _reader(spark: SparkSession, sep: str, encoding: str, header: bool, multi_line: bool = False):
    """Quotes inside quotes are doubled. ``multi_line`` allows newlines inside quotes; such a
    file cannot be split, so one task reads it whole: use it only where needed. The header of
    every file must agree with the columns read (``enforceSchema`` off), else the read fails."""
    return (spark.read.option("header", str(header).lower()).option("sep", sep)
            .option("encoding", encoding).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("enforceSchema", "false")
            .option("multiLine", str(multi_line).lower()))


def header_columns(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names from the header line (no schema inference pass)."""
    return _reader(spark, sep, encoding, True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ";",
             encoding: str = "ISO-8859-1", header: bool = True,
             keep_extra: bool = False, multi_line: bool = False) -> DataFrame:
    """SRC-2: header CSV typed by a declared schema, matched BY NAME.

    A schema handed to the CSV reader is applied by position and the header
    is ignored, so a file whose column order differs from the contract would
    be silently misread. Instead every column is read as text under its
    header name and then cast by name (null tokens -> NULL, ``try_cast``).
    Without a schema, or without a header, the file stays all text.
    """
    if not header:
        raw = _reader(spark, sep, encoding, False, multi_line).csv(path)
        return raw if schema is None else typed_projection(raw, schema, keep_extra=keep_extra)
    names = header_columns(spark, path, sep, encoding)
    text_schema = StructType([StructField(n, StringType(), True) for n in names])
    raw = _reader(spark, sep, encoding, True, multi_line).schema(text_schema).csv(path)
    return raw if schema is None else typed_projection(raw, schema, keep_extra=keep_extra)


def malformed_rows(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1",
                   multi_line: bool = False) -> DataFrame:
    """Rows with more or fewer fields than the header, with their text in ``_corrupt_record``.

    :func:`read_csv` keeps such rows, without surplus fields and with NULL for
    missing ones; count them here (one scan) where the source is not trusted.
    """
    names = header_columns(spark, path, sep, encoding)
    schema = StructType([StructField(n, StringType(), True) for n in (*names, "_corrupt_record")])
    return (_reader(spark, sep, encoding, True, multi_line).option("enforceSchema", "true")
            .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).csv(path)
            .where(F.col("_corrupt_record").isNotNull()))


def sniff_text(spark: SparkSession, path: str) -> tuple[str, bool]:
    """Encoding, and whether some quoted field goes on over a line end: one scan of the whole input.

    'UTF-8' when every line is valid UTF-8, else 'ISO-8859-1'.
    """
    # bytes are counted: in Latin-1 text a letter's byte may seem to take the quote after it in
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    seen = (spark.read.text(path)
            .agg(F.count_if(~F.is_valid_utf8("value")).alias("bad"),
                 F.count_if(quotes % 2 == 1).alias("odd")).first())
    return ("ISO-8859-1" if seen["bad"] else "UTF-8"), bool(seen["odd"])


def detect_encoding(spark: SparkSession, path: str) -> str:
    """'UTF-8' when every line is valid UTF-8, else 'ISO-8859-1' (whole input checked)."""
    return sniff_text(spark, path)[0]


def detect_separator(spark: SparkSession, path: str,
                     candidates: tuple[str, ...] = CANDIDATE_SEPARATORS) -> str:
    """The candidate occurring most often in the header line."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0]["value"] if first else ""
    counts = {c: line.count(c) for c in candidates}
    best = max(candidates, key=lambda c: counts[c])
    return best if counts[best] > 0 else ","


def detect_multi_line(spark: SparkSession, path: str) -> bool:
    """Whether some quoted field goes on over a line end (whole input checked)."""
    return sniff_text(spark, path)[1]


def read_multi_line_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                        sep: str = ";", encoding: str = "ISO-8859-1",
                        keep_extra: bool = False) -> DataFrame:
    """:func:`read_csv` of files with newlines inside quotes, by many tasks a file.

    Rows are those of ``multi_line=True``, with line ends inside quotes as
    one newline. A file whose quotes do not pair up (:func:`csv_lines.stray_quotes`)
    is logged and read as a whole by one task; the others stay split.
    """
    names = header_columns(spark, path, sep, encoding)
    text_schema = StructType([StructField(n, StringType(), True) for n in names])
    lines = quoted_lines(spark, path, sep, encoding)
    stray = stray_quotes(lines)
    whole = sorted(unquote(r["file"]) for r in stray.select("file").collect())  # file names only
    if whole:
        log.warning("quotes do not pair up in %d files, read by one task each: %s",
                    len(whole), whole[:10])
        lines = lines.join(stray.select("file"), "file", "left_anti")
    raw = parse_records(records(lines), text_schema, sep)
    if whole:
        raw = raw.unionByName(_reader(spark, sep, encoding, True, True).schema(text_schema).csv(whole))
    return raw if schema is None else typed_projection(raw, schema, keep_extra=keep_extra)


def read_csv_sniffed(spark: SparkSession, path: str, schema: StructType | None = None,
                     keep_extra: bool = False) -> DataFrame:
    """SRC-3 (+ SRC-4 / SRC-5): detect encoding, separator and line ends inside quotes, then type."""
    encoding, multi_line = sniff_text(spark, path)
    read = read_multi_line_csv if multi_line else read_csv
    return read(spark, path, schema, sep=detect_separator(spark, path), encoding=encoding,
                keep_extra=keep_extra)


def write_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> None:
    """Delimited export with a header (used to stage raw files)."""
    (df.write.mode("overwrite").option("header", "true").option("sep", sep)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("encoding", encoding).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
     .csv(path))
