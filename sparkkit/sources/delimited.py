"""Readers for delimited text files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from sparkkit.sources import schemas


def read_lines(spark: SparkSession, path: str | list[str], skip_lines: int = 0) -> DataFrame:
    """Lines of text files (bz2 and gz by extension) as ``value``.

    ``skip_lines`` drops that many lines at the top of every file, also where they reach beyond
    the file's first split. A line's place is known from its split and its row id in the
    task. The lines of each split are counted, one row per split, and summed up along the
    file; only splits in which lines are dropped are joined back.
    """
    lines = spark.read.text(path)
    if not skip_lines:
        return lines
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    splits = placed.groupBy("file", "start").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(along), F.lit(0))
    top = splits.select("file", "start", "first", before.alias("before")).where(F.col("before") < skip_lines)
    on_top = F.col("first").isNotNull() & (F.col("before") + F.col("row") - F.col("first") < skip_lines)
    return placed.join(top, ["file", "start"], "left").where(~on_top).select("value")


def split_fields(lines: DataFrame, sep: str = ",", min_fields: int = 0) -> DataFrame:
    """``fields``, the positional values of each line; shorter lines can be dropped."""
    pattern = "".join(f"\\{ch}" if not ch.isalnum() else ch for ch in sep)
    fields = lines.select(F.split("value", pattern, -1).alias("fields"))
    return fields.where(F.size("fields") >= min_fields) if min_fields else fields


def pick_fields(fields: DataFrame, positions: Sequence[int], names: Sequence[str]) -> DataFrame:
    """Named columns from positional fields; a missing position is null."""
    return fields.select(
        *(F.get("fields", F.lit(at)).alias(name) for at, name in zip(positions, names, strict=True))
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    header: bool = False,
    skip_lines: int = 0,
    quote: str = '"',
) -> DataFrame:
    """A delimited file with a declared schema; no data line is lost without ``header`` or ``skip_lines``."""
    options = {"sep": sep, "quote": quote, "mode": "PERMISSIVE"}
    if not skip_lines:
        return spark.read.schema(schema).options(header=str(header).lower(), **options).csv(path)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    lines = read_lines(spark, path, skip_lines + int(header))
    return lines.select(F.from_csv("value", ddl, options).alias("row")).select("row.*")


def or_default(column: str | Column, default: str) -> Column:
    """The value, or ``default`` where it is null or empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def read_trips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Trip lines with exactly 17 fields, as strings under their names; other lines are dropped."""
    reader = spark.read.schema(schemas.TRIP).option("quote", "").option("mode", "DROPMALFORMED")
    return reader.option("columnPruning", "false").csv(path)


def read_flights(spark: SparkSession, path: str | list[str], skip_lines: int = 1) -> DataFrame:
    """Flight lines reduced to 13 columns; an empty delay counts as 0.

    Fields after the last one needed are never parsed.
    """
    wide = schemas.text_schema(*(f"f{at}" for at in range(max(schemas.FLIGHT_POSITIONS) + 1)))
    top = {"header": True} if skip_lines == 1 else {"skip_lines": skip_lines}
    lines = read_delimited(spark, path, wide, quote="", **top)
    flights = lines.select(
        *(F.col(f"f{at}").alias(n) for at, n in zip(schemas.FLIGHT_POSITIONS, schemas.FLIGHT.names, strict=True))
    )
    flights = flights.withColumn("departure_delay", or_default("departure_delay", "0"))
    return cast_columns(
        flights, {"year": "int", "month": "int", "day": "int", "day_of_week": "int", "departure_delay": "int"}
    )


def read_links(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Quoted (document, category) lines; commas may stand inside the quotes."""
    return read_delimited(spark, path, schemas.CATEGORY_LINK)
