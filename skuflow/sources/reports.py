"""Tolerant scans of marketplace report files.

Every column is read as a string (keys must never become numbers, L1); cleaning
happens in the builders with built-in expressions. Three reader quirks are
handled explicitly because Spark is silent about them: ``escape='"'`` is needed
for JSON cells written with doubled quotes, ``skipRows`` is not honoured by the
CSV source (preambles are dropped from a text scan instead), and undecodable
bytes become U+FFFD rather than an error (detected and re-read as Latin-1).

A row with more cells than the header is malformed: cells would be lost. Its raw text is
kept by the scan, and either the file is refused when a job meets it, or such rows are
put aside with the reason. Short rows are complete with missing cells, as exports write them.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.functions.text import NA_TOKENS


def separator_for(path: str, default: str = ",") -> str:
    """``.txt`` exports are tab-separated, everything else comma-separated."""
    return "\t" if path.lower().endswith(".txt") else default


#: Holds the raw text of a malformed row, else NULL.
MALFORMED = "_malformed_row"


class MalformedReport(ValueError):
    """The file is no report of the expected shape."""


def _null_tokens(df: DataFrame) -> DataFrame:
    """L3: pandas-style NA tokens and blanks -> NULL (Spark's ``nullValue`` takes one token)."""
    return df.select(*[F.col(c) if c == MALFORMED else
                       F.when(F.trim(F.col(f"`{c}`")).isin(NA_TOKENS), None).otherwise(F.col(f"`{c}`")).alias(c)
                       for c in df.columns])


def _cells(record: Column, sep: str) -> Column:
    """Cells of a raw CSV record: separators outside quotes, plus one."""
    bare = F.regexp_replace(record, '"[^"]*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep))) + 1


def _judged(df: DataFrame, width: int, sep: str, malformed: str) -> DataFrame:
    """The scan's raw text stays only where a row has more cells than the header.

    ``malformed="refuse"``: a job that reads such a row fails (the file counts as unreadable).
    ``"quarantine"``: the column MALFORMED marks the rows for ``split_malformed``.
    """
    # the scan keeps no raw text for a query that reads nothing else, so a cell is named too
    read = F.length(F.coalesce(F.col("c0"), F.lit(""))) >= 0
    surplus = read & F.col(MALFORMED).isNotNull() & (_cells(F.col(MALFORMED), sep) > width)
    if malformed == "quarantine":
        return df.withColumn(MALFORMED, F.when(surplus, F.col(MALFORMED)))
    if malformed != "refuse":
        raise ValueError("malformed is 'refuse' or 'quarantine'")
    message = F.concat(F.lit(f"malformed report: a row has more than {width} cells: "), F.substring(MALFORMED, 1, 200))
    return df.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))).drop(MALFORMED)


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows as their raw text) of a scan with ``malformed="quarantine"``."""
    return df.where(F.col(MALFORMED).isNull()).drop(MALFORMED), df.where(F.col(MALFORMED).isNotNull()).select(MALFORMED)


def _scan(spark: SparkSession, path: str, cols: list[str], sep: str, enc: str, header: bool) -> DataFrame:
    """All-string scan under positional names, with the raw text of rows of another width."""
    schema = ", ".join([*(f"`c{i}` string" for i in range(len(cols))), f"`{MALFORMED}` string"])
    return (spark.read.schema(schema).option("header", header).option("escape", '"').option("sep", sep)
            .option("encoding", enc).option("mode", "PERMISSIVE").option("multiLine", True)
            .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
            .option("enforceSchema", True).csv(path))


def head_lines(spark: SparkSession, path: str, n: int, encoding: str = "UTF-8") -> list[str]:
    """First ``n`` physical lines of one file."""
    rows = spark.read.option("encoding", encoding).text(path).limit(n).collect()
    return [r.value for r in rows]


def has_bad_bytes(spark: SparkSession, path: str) -> bool:
    """Does the file contain byte sequences that are not valid UTF-8?"""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count() > 0


def read_report(spark: SparkSession, path: str, sep: str | None = None, skip_lines: int = 0,
                encoding: str = "auto", malformed: str = "refuse") -> DataFrame:
    """Header CSV/TSV as all-string columns.

    ``skip_lines`` drops that many preamble lines before the header (S3).
    ``encoding='auto'`` reads UTF-8 and falls back to Latin-1 when the file has
    undecodable bytes (S2). ``malformed``: see ``_judged``.
    """
    sep = sep or separator_for(path)
    enc = encoding
    if encoding == "auto":
        enc = "ISO-8859-1" if has_bad_bytes(spark, path) else "UTF-8"
    if skip_lines == 0:
        cols = (spark.read.option("header", True).option("escape", '"').option("sep", sep)
                .option("encoding", enc).option("multiLine", True).csv(path).columns)
        if not cols:
            return spark.createDataFrame([], "value string")
        rows = _judged(_scan(spark, path, cols, sep, enc, True), len(cols), sep, malformed)
        return _null_tokens(_named(rows, cols))
    return _read_after_preamble(spark, path, sep, skip_lines, enc, malformed)


def _named(rows: DataFrame, cols: list[str]) -> DataFrame:
    return rows.toDF(*cols, *([MALFORMED] if MALFORMED in rows.columns else []))


def _read_after_preamble(spark: SparkSession, path: str, sep: str, skip_lines: int, enc: str,
                         malformed: str = "refuse") -> DataFrame:
    """S3: the first ``skip_lines`` lines are preamble; the next one is the header.

    The header text is taken from the head of the file. The whole file is parsed with an
    all-string schema of its width, quoted line breaks included (one task a file, so row ids
    follow the file), and rows up to the first one equal to the header are dropped by
    position. A data row equal to a preamble line stays. A file without that header is refused.
    """
    head = head_lines(spark, path, skip_lines + 1, enc)
    if len(head) <= skip_lines:
        return spark.createDataFrame([], "value string")
    header = head[skip_lines]
    cols = next(csv.reader([header.lstrip("\ufeff")], delimiter=sep))
    rows = _scan(spark, path, cols, sep, enc, False).withColumn("_i", F.monotonically_increasing_id())
    is_header = reduce(Column.__and__, [F.col(f"c{i}") == F.lit(c) for i, c in enumerate(cols) if c.strip()])
    at = rows.where(is_header).agg(F.min("_i").alias("i")).first().i
    if at is None:
        raise MalformedReport(f"{path}: no row equals the header {cols}")
    body = rows.where(F.col("_i") > at).drop("_i")
    return _null_tokens(_named(_judged(body, len(cols), sep, malformed), cols))


@dataclass
class Sniffed:
    skip_lines: int
    sep: str


def sniff_header(spark: SparkSession, path: str, marker: str, fallback_skip: int = 2) -> Sniffed:
    """The first line containing ``marker``, anywhere in the file, is the header; ``;``
    wins when it occurs more often than ``,`` on that line; otherwise skip ``fallback_skip``."""
    lines = spark.read.option("wholetext", False).text(path).select("value", F.monotonically_increasing_id().alias("i"))
    hit = lines.where(F.col("value").contains(marker)).agg(F.min(F.struct("i", "value")).alias("h")).first().h
    if hit is None:
        return Sniffed(fallback_skip, ",")
    return Sniffed(hit.i, ";" if hit.value.count(";") > hit.value.count(",") else ",")


def read_sniffed(spark: SparkSession, path: str, marker: str) -> DataFrame:
    s = sniff_header(spark, path, marker)
    return read_report(spark, path, sep=s.sep, skip_lines=s.skip_lines)
