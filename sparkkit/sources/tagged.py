"""Documents written as one ``<doc id=".." url=".." title="..">body</doc>`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.sources.delimited import read_lines

END_TAG = "</doc>"


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def between(column: str | Column, left: str, right: str) -> Column:
    """Text between the first ``left`` and the first ``right``; null when either is missing."""
    value = _col(column)
    start = F.instr(value, left) + len(left)
    stop = F.instr(value, right)
    return F.when(
        (F.instr(value, left) > 0) & (stop >= start), F.substr(value, start, stop - start)
    )


def doc_id(column: str | Column) -> Column:
    return between(column, 'id="', '" url=')


def doc_url(column: str | Column) -> Column:
    return between(column, '" url="', '" title=')


def doc_title(column: str | Column) -> Column:
    return between(column, '" title="', '">')


def doc_body(column: str | Column) -> Column:
    """Everything after the header tag, without the end tag."""
    value = _col(column)
    start = F.instr(value, '">') + 2
    return F.when(start > 2, F.substr(value, start, F.length(value) - start + 1 - len(END_TAG)))


def header_tag(column: str | Column) -> Column:
    """The first ``<…>`` of the line, or an empty string."""
    return F.regexp_extract(_col(column), "(<[^>]+>)", 1)


def group_of(column: str | Column) -> Column:
    """Second path element of a document id such as ``corpus/group/number``."""
    return F.regexp_extract(_col(column), "^[^/]+/([^/]+)/", 1)


def tagged_span(column: str | Column) -> Column:
    """Text after the first ``>`` up to the end tag, or to the end where there is none."""
    value = _col(column)
    return F.substring_index(F.substr(value, F.instr(value, ">") + 1), END_TAG, 1)


def is_document(column: str | Column) -> Column:
    value = _col(column)
    return F.contains(value, F.lit("id")) & F.contains(value, F.lit("url="))


def parse_tagged(lines: DataFrame, column: str = "value") -> DataFrame:
    """``doc_id, url, title, text`` of the lines that hold a document."""
    parsed = lines.where(is_document(column)).select(
        doc_id(column).alias("doc_id"),
        doc_url(column).alias("url"),
        doc_title(column).alias("title"),
        doc_body(column).alias("text"),
    )
    return parsed.where("doc_id is not null and text is not null")


def read_tagged(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_tagged(read_lines(spark, path))
