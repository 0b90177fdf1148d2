"""Tables that loops read again every round: parts of equal size, lists as bytes, sums in parts."""

import numpy as np
import pyarrow as pa

from sparkkit.operators import logistic, mixture, packed


def one_part(spark, kind):
    rows = [(f"d{k}", float(k % 2), list(range(k % 5)), [float(k + j) for j in range(k % 5)]) for k in range(60)]
    return spark.createDataFrame(rows, "doc_id string, label double, idx array<int>, val array<double>").coalesce(1).withColumn("cnt", packed.F.col("val").cast(kind))


def test_lists_and_bytes_hold_the_same_numbers(spark):
    rows = one_part(spark, "array<int>")
    stored = packed.stored_packed(rows, "rows", idx=np.int32, val=np.float64)
    assert dict(stored.dtypes)["idx"] == dict(stored.dtypes)["val"] == "binary" and stored.rdd.getNumPartitions() > 1
    found = {r.doc_id: (np.frombuffer(r.idx, np.int32).tolist(), np.frombuffer(r.val).tolist()) for r in stored.collect()}
    assert found == {r.doc_id: (r.idx, r.val) for r in rows.collect()}
    column = pa.array([b"", np.arange(3, dtype=np.int32).tobytes(), b""])
    lengths, numbers = packed.flat(column.slice(1), np.int32)
    assert lengths.tolist() == [3, 0] and numbers.tolist() == [0, 1, 2]
    assert packed.row_sums(np.array([1.0, 2.0, 4.0]), np.array([0, 2, 0, 1, 0])).tolist() == [0, 3, 0, 4, 0]


def test_parts_are_added(spark):
    emit = lambda batches: (packed.sliced(np.arange(10.0) * (i + 1), 4) for batch in batches for i in batch.column(0).to_pylist())
    parts = spark.range(3).repartition(2).mapInArrow(emit, "part bigint, numbers array<double>")
    assert packed.added(parts, 10, 4).tolist() == (np.arange(10.0) * 6).tolist()
    assert packed.added(parts.where("part < 0"), 10, 4).tolist() == [0] * 10


def test_a_round_of_the_mixture_uses_several_tasks_and_counts_in_blocks(spark, monkeypatch):
    seen, whole = [], mixture._sampled

    def sampled(rows, *more):
        found = whole(rows, *more)
        seen.append((rows.rdd.getNumPartitions(), found.columns))
        return found

    monkeypatch.setattr(mixture, "_sampled", sampled)
    mixture.gibbs(mixture.document_rows(one_part(spark, "array<bigint>")), 2, 5, 1)
    assert seen[0][0] > 1 and seen[0][1] == ["block", "at", "n"]


def test_a_round_of_the_descent_uses_several_tasks(spark, monkeypatch):
    seen, whole = [], logistic.added

    def added(parts, *more):
        seen.append(parts.rdd.getNumPartitions())
        return whole(parts, *more)

    monkeypatch.setattr(logistic, "added", added)
    logistic.fit(one_part(spark, "array<int>"), 5, rounds=1)
    assert seen[0] > 1
