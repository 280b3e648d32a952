"""File sinks. Each writes a folder of part files in one job; nothing is gathered in one task."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.catalog import quote_part
from lakeloom.sources.files import ESCAPED_BREAKS, NO_ESCAPE, NO_QUOTE, NO_SEPARATOR, NULL_MARK

# Microseconds are kept in text formats.
NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"

# Characters the text form of numbers, booleans, dates and timestamps can be made of.
_PLAIN_TEXT = frozenset("0123456789+-.: ")

# What no value of an unquoted row may hold besides the separator.
_BREAKS = ("\n", "\r", NULL_MARK, NO_SEPARATOR, NO_QUOTE, NO_ESCAPE)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """JSON lines; timestamps keep their microseconds."""
    formats = {"timestampFormat": LTZ_FORMAT, "timestampNTZFormat": NTZ_FORMAT}
    df.write.mode(mode).options(**formats).json(path)


def _loses_blank_lines(df: DataFrame, sep: str) -> bool:
    """Can a row be a line of white space only? Readers of delimited text skip such lines."""
    return len(df.columns) == 1 or sep.strip() == ""


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    mode: str = "error",
    max_records_per_file: int = 0,
    breaks: str = "quoted",
) -> None:
    """Delimited text that quotes a value where it must, doubling quotes inside.

    Where a row could be a blank line (one column, or a separator of white space), all values are
    quoted and a null is written as :data:`~lakeloom.sources.files.NULL_MARK`, so that every row comes
    back. A text value equal to the mark is an error.

    ``breaks="escaped"`` writes line feeds and carriage returns inside values as marks
    (:data:`~lakeloom.sources.files.ESCAPED_BREAKS`), which the reader turns back. So a line is a record, and files of any
    size are read by many tasks. Text with such a mark is an error. With ``"quoted"`` breaks stand as they are, and only
    ``max_records_per_file`` bounds the files of readers that then cannot split them.
    """
    if breaks not in ("quoted", "escaped"):
        raise ValueError(f"breaks are 'quoted' or 'escaped', not {breaks!r}")
    if breaks == "escaped" and header and any(set(name) & {"\n", "\r"} for name in df.columns):
        raise ValueError(f"a column name would break the header: {df.columns}")
    options = {}
    if _loses_blank_lines(df, sep):
        options = {"quoteAll": True, "nullValue": NULL_MARK}
    checked = []
    for field in df.schema:
        value = F.col(quote_part(field.name))
        if isinstance(field.dataType, T.StringType):
            problem = F.raise_error(f"column {field.name} holds the null mark").cast("string")
            text = value
            if breaks == "escaped":
                marked = F.raise_error(f"column {field.name} holds a mark of an escaped break").cast("string")
                text = F.when(value.rlike(f"[{ESCAPED_BREAKS}]"), marked).otherwise(F.translate(value, "\n\r", ESCAPED_BREAKS))
            value = F.when(value == NULL_MARK, problem).otherwise(text).alias(field.name)
        checked.append(value)
    df.select(*checked).write.mode(mode).options(
        sep=sep,
        header=header,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampFormat=LTZ_FORMAT,
        timestampNTZFormat=NTZ_FORMAT,
        maxRecordsPerFile=max_records_per_file,
        **options,
    ).csv(path)


def _may_hold(data_type: T.DataType, sep: str) -> bool:
    if isinstance(data_type, T.StringType):
        return True
    return sep in _PLAIN_TEXT or sep.isalnum()


def _breaks_row(df: DataFrame, sep: str) -> list[tuple[str, Column]]:
    """Per column that could hold it: does the value contain a separator, a break or a mark?"""
    checks = []
    for field in df.schema:
        if _may_hold(field.dataType, sep):
            value = F.col(quote_part(field.name)).cast("string")
            broken = value.contains(sep)
            for other in _BREAKS:
                broken = broken | value.contains(other)
            checks.append((field.name, broken))
    return checks


def count_ambiguous(df: DataFrame, sep: str = "|") -> DataFrame:
    """One row: how many rows unquoted text could not give back, by column and in all."""
    checks = _breaks_row(df, sep)
    ambiguous = F.lit(False)
    for _, check in checks:
        ambiguous = ambiguous | F.coalesce(check, F.lit(False))
    return df.agg(
        F.count_if(ambiguous).alias("ambiguous_rows"),
        *[F.count_if(check).alias(name) for name, check in checks],
    )


def write_unquoted(
    df: DataFrame,
    path: str,
    sep: str = "|",
    header: bool = True,
    mode: str = "error",
    on_ambiguous: str = "error",
) -> None:
    """Delimited text with no quoting at all; nulls and empty strings are both empty fields.

    A separator or record break inside a value would shift or split its row. The writing pass
    itself checks for that and fails before anything is committed. ``on_ambiguous="keep"`` lets
    separators through; record breaks stay an error. A row of empty fields that would be a blank line
    begins with :data:`~lakeloom.sources.files.NULL_MARK`; one of other white space is an error.
    """
    if len(sep) != 1:
        raise ValueError("the separator is one character")
    if on_ambiguous not in ("error", "keep"):
        raise ValueError(f"on_ambiguous is 'error' or 'keep', not {on_ambiguous!r}")
    if header and any(set(name) & {sep, "\n", "\r"} for name in df.columns):
        raise ValueError(f"a column name would break the header: {df.columns}")
    guards = dict(_breaks_row(df, sep))
    fields = []
    for name in df.columns:
        text = F.coalesce(F.col(quote_part(name)).cast("string"), F.lit(""))
        if name in guards:
            bad = guards[name]
            if on_ambiguous == "keep":
                bad = reduce(or_, [text.contains(other) for other in _BREAKS])
            problem = F.raise_error(f"column {name}: a value would break its unquoted row")
            text = F.when(bad, problem.cast("string")).otherwise(text)
        fields.append(text)
    # One text column named like the header line. Separator and quote of the CSV writer are no text
    # here, so it never quotes and each line is the row as built.
    line = F.concat_ws(sep, *fields)
    if _loses_blank_lines(df, sep):
        empty = reduce(and_, [field == "" for field in fields])
        marked = F.concat_ws(sep, F.lit(NULL_MARK), *fields[1:])
        blank = F.raise_error("a row of white space only would be lost in unquoted text").cast("string")
        line = F.when(empty, marked).when(line.rlike(r"^[\x00-\x20]*$"), blank).otherwise(line)
    df.select(line.alias(sep.join(df.columns))).write.mode(mode).options(
        sep=NO_SEPARATOR,
        quote=NO_QUOTE,
        escapeQuotes=False,
        emptyValue="",
        header=header,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
