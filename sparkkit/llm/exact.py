"""Exact duplicates by distributed radix partitioning on the bytes of the texts, first byte first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import SPACE, stored
from sparkkit.session import materialize, new_path

#: Bytes compared in the first round; each later round compares GROWTH times as many.
FIRST, GROWTH = 64, 4


def normalised(text: Column | str) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), f"{SPACE}+", " ")


def _split(rows: DataFrame, keys: list[str], width: Column) -> DataFrame:
    """One radix step: rows (row, doc_id, keys with chunk last) that share all keys with another row.

    Groups are counted with partial sums, so a group that holds a third of all rows is one row
    per task when it is dealt out; the join back splits its large partitions by itself. Groups may
    be as many as half the rows, so they are never broadcast, however few they are. The new
    group is named by its smallest row. ``ended``: the chunk is shorter than the round's width, so
    the texts end in it and are equal.
    """
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("doc_id", "row")).alias("first")).filter("size > 1")
    return rows.join(groups.hint("merge"), keys).select("row", "doc_id", "first", "size", (F.octet_length("chunk") < width).alias("ended"))


def groups(docs: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, and the columns ``carry``.

    Texts are equal when their normalised forms are the same bytes; ``keep_id`` is the smallest
    doc_id among equal texts (a null id is the smallest), ``kept`` marks exactly one row of each
    group, also where rows of one id are repeated. Null texts equal empty ones. ``carry`` are
    expressions over the input columns.

    Round by round, rows that still share all bytes so far with another row are split by the
    next bytes: 64, 256, 1024, ... of them. A row leaves when it is alone or its text has ended.
    The first round reads only the first bytes. To find the texts of what is left, texts are
    always dealt out by row: what is left may be most of the table. The bytes that later rounds need are laid out
    once, by round, for the rows that have not left by then, so a long text takes few rounds and
    each round moves only its own bytes. No digest takes part in a decision.
    """
    carried = {f"carry_{k}": c for k, c in enumerate((carry or {}).values())}
    norm = normalised("text")
    texts = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", norm.cast("binary").alias("bytes"),
        *[c.alias(name) for name, c in carried.items()],
    ).withColumn("chunk", F.substring("bytes", 1, FIRST)), "texts")

    done = []
    alive = materialize(_split(texts.select("row", "doc_id", "chunk"), ["chunk"], F.lit(FIRST)), "alive")
    done.append(alive.filter("ended"))
    alive = alive.filter("NOT ended")
    if not alive.isEmpty():
        # round k = 1, 2, ... begins after FIRST * (GROWTH^k - 1) / (GROWTH - 1) bytes
        last = F.ceil(F.log(F.octet_length("bytes") * (GROWTH - 1.0) / FIRST + 1.0) / F.log(F.lit(float(GROWTH)))).cast("int") + 1
        start = f"cast({FIRST} * (power({GROWTH}, round) - 1) / {GROWTH - 1} as int)"
        chunks = (
            texts.select("row", "bytes").join(alive.select("row").hint("merge"), "row", "left_semi")
            .select("row", "bytes", F.explode(F.sequence(F.lit(1), last)).alias("round"))
            .filter(f"{start} <= octet_length(bytes)")
            .select("row", "round", F.expr(f"substring(bytes, {start} + 1, cast({FIRST} * power({GROWTH}, round) as int))").alias("chunk"))
        )
        chunks = _by_round(chunks)
        k = 1
        while not alive.isEmpty():
            step = chunks.filter(F.col("round") == k).select("row", "chunk").join(
                alive.select("row", "doc_id", F.col("first.row").alias("group")).hint("merge"), "row"
            )
            alive = materialize(_split(step, ["group", "chunk"], F.lit(FIRST * GROWTH**k)), "alive")
            done.append(alive.filter("ended"))
            alive = alive.filter("NOT ended")
            k += 1
    ended = done[0]
    for more in done[1:]:
        ended = ended.unionByName(more)
    ended = ended.select("row", F.col("first").alias("leader"), "size")
    alone = F.col("leader").isNull()
    return texts.select("row", "doc_id", *carried).join(ended.hint("merge"), "row", "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("leader.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("leader.row") == F.col("row"))).alias("kept"),
        *[F.col(k).alias(name) for k, name in zip(carried, carry or {})],
    )


def _by_round(chunks: DataFrame) -> DataFrame:
    """The chunks as a table in the shared folder with a part for each round."""
    path = new_path(chunks.sparkSession, "chunks")
    chunks.write.partitionBy("round").option("compression", "zstd").parquet(path)
    return chunks.sparkSession.read.schema("row bigint, chunk binary, round int").parquet(path)


def dedup(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of one row of each group of equal texts, the one with the smallest doc_id."""
    held = groups(docs, {f"column_{k}": F.col(c) for k, c in enumerate(columns)}).filter("kept")
    return held.select(*[F.col(f"column_{k}").alias(c) for k, c in enumerate(columns)])
