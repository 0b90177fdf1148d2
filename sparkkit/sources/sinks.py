"""Writers: one file for a small report, part files for everything else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """One text column; nulls become empty fields."""
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in df.columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write a result as one text file, in its order.

    Only the lines pass to the one task that writes; the result is computed once, in as many tasks as it has.
    """
    lines = as_lines(df, sep).select("value", F.monotonically_increasing_id().alias("at"))
    lines.repartition(1).sortWithinPartitions("at").select("value").write.text(path)


def write_parts(df: DataFrame, path: str, sep: str = ",", top_lines: tuple[str, ...] = ()) -> None:
    """Write part files, each opened by ``top_lines``."""
    lines = as_lines(df, sep)
    if top_lines:
        in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        opening = F.array(*(F.lit(line) for line in top_lines), F.col("value"))
        lines = lines.select("value", in_task.alias("at")).select(
            F.explode(F.when(F.col("at") == 0, opening).otherwise(F.array("value"))).alias("value")
        )
    lines.write.text(path)


def write_links(df: DataFrame, path: str) -> None:
    """Write every field in double quotes."""
    df.write.option("quoteAll", "true").csv(path)
