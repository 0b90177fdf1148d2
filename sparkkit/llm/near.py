"""Near duplicates by one-permutation hashing, banded buckets and star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkkit.llm.common import slices, small_batches, stored
from sparkkit.session import materialize

BANDS, ROWS = 40, 5
SLOTS = BANDS * ROWS
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The set of each text, as sorted 64-bit hashes of its runs of ``words`` words.

    A-Z are lower-cased; words stand between white space. A text with fewer words, but one at
    least, has its whole sequence as its one shingle; one without words has none.
    """
    parts = [(text or "").encode().lower().split() for text in texts]
    known: dict[bytes, int] = {}
    number = xxhash.xxh3_64_intdigest
    for part in parts:
        for word in part:
            if word not in known:
                known[word] = number(word)
    out = []
    for part in parts:
        hashes = np.fromiter(map(known.__getitem__, part), np.uint64, len(part))
        if not len(part):
            out.append(hashes)
            continue
        size = min(words, len(part))
        runs = np.full(len(part) - size + 1, np.uint64(size))
        for k in range(size):
            runs = mix(runs * _ODD[0] + hashes[k : len(part) - size + 1 + k])
        out.append(np.unique(runs))
    return out


@lru_cache(2)
def _borrowing(slots: int) -> np.ndarray:
    """For each slot, in which order it looks at the others when it is empty: a random order of its own."""
    rng = np.random.default_rng(20170801)
    return np.argsort(rng.random((slots, slots)), axis=1).T


def signature(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """One-permutation signature: the range of hashes is cut into slots, each keeps its least one.

    An empty slot takes the value of the first filled slot in its own random order of slots
    (optimal densification), so any two signatures agree in a slot with the sets' similarity.
    """
    found = mix(hashes ^ _ODD[1])
    found.sort()
    at = ((found >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    filled = np.zeros(slots, bool)
    filled[at[first]] = True
    values = np.zeros(slots, np.uint64)
    values[at[first]] = found[first]
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _borrowing(slots)[:, empty]
        values[empty] = values[order[filled[order].argmax(axis=0), np.arange(len(empty))]]
    return values


def band_keys(values: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of a signature; the band's number goes into it."""
    rows = values.reshape(bands, -1)
    key = mix(np.arange(bands, dtype=np.uint64) * _ODD[2] + np.uint64(1))
    for k in range(rows.shape[1]):
        key = mix(key * _ODD[0] + rows[:, k])
    return key


def describe(docs: DataFrame, words: int) -> DataFrame:
    """row, doc_id, n_shingles, and for texts with words a digest of the set (two numbers) and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches):
            sets = shingle_sets(block.column("text").to_pylist(), words)
            keys = [band_keys(signature(s)).view(np.int64) if len(s) else None for s in sets]
            digests = [xxhash.xxh3_128_intdigest(s) for s in sets]
            halves = [pa.array(np.array([d >> shift & (2**64 - 1) for d in digests], np.uint64).view(np.int64)) for shift in (64, 0)]
            columns = [block.column("row"), block.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *halves, pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_shingles", "high", "low", "keys"])

    return docs.mapInArrow(run, "row bigint, doc_id bigint, n_shingles bigint, high bigint, low bigint, keys array<bigint>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """row and its whole set, as binary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches):
            sets = shingle_sets(block.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([block.column("row"), pa.array([s.tobytes() for s in sets], pa.binary())], ["row", "set"])

    return docs.mapInArrow(run, "row bigint, set binary")


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``edges`` (a, b) whose whole sets have at least ``percent`` hundredths of their union in common."""
    left = sets.select(F.col("row").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("row").alias("b"), F.col("set").alias("set_b"))
    pairs = edges.join(right.hint("merge"), "b").join(left.hint("merge"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node and the smallest node that it can reach, for the nodes of ``edges`` (a, b).

    Large stars and small stars in turn: each node's larger neighbours, then its smaller ones,
    are tied to the smallest node around it, until nothing changes. A round is stored in the
    shared folder, and takes rows in proportion to the edges.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()

    now = materialize(ordered(edges), "stars")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = ordered(both.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("least").alias("b")))
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(smallest.hint("merge"), "a")
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(smallest.select("a", F.col("least").alias("b")))
        after = materialize(ordered(small), "stars")
        same = after.count() == now.count() and after.join(now, ["a", "b"], "left_anti").isEmpty()
        now = after
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def link(docs: DataFrame, words: int = 5, percent: int = 80, block: int = 512, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Rows are linked when 100 times the shingles that both sets hold is at least ``percent``
    times those that either holds; a component is what can be reached over links, named by its
    smallest doc_id, and ``kept`` marks the row that bears it (one row, if rows are
    repeated). Null and blank texts have an empty set and are linked with nothing; a null doc_id
    sorts first. ``carry`` names columns to be kept as well, others are left out; rows get a number
    of their own and are stored once, so that the number stays.

    1. Each text gives its set's digest and 40 band keys of a 200-slot signature. At a similarity
       of 0.8, all 40 bands miss with a chance of up to about 1e-5 (a reviewer's simulation).
    2. Rows of equal sets become one class. Buckets are formed over classes only.
    3. In each bucket the class with the largest sum of bucket sizes is the hub, and only the
       pairs (hub, other) are candidates, at most one per bucket row.
    4. Candidates are confirmed on whole sets, and components are formed.
    5. Buckets that still hold rows of several components are gone through to the end. Their rows
       are gathered by what buckets tie together, so a row comes once however many buckets it
       shares, and compared in squares of ``block`` rows: first by signature (a pair must share a band,
       and agree in 0.62 of the slots, 0.5 for small sets), then on whole sets, leaving out pairs
       that links have tied together by then. Only links that tie something come out. Nothing is
       capped, so every similar pair that shares a bucket and agrees in so many slots ends up in one component.

    Any side of a join may be a large part of the rows, so all are joined by sorting, with large
    partitions split; none is broadcast because it happens to be small.
    """
    small_batches(docs)
    held = {f"carry_{k}": c for k, c in enumerate(carry) if c not in ("doc_id", "text")}
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[F.col(c).alias(k) for k, c in held.items()],
    ), "rows")
    seen = materialize(describe(rows.select("row", "doc_id", "text"), words), "signatures")
    filled = seen.filter("n_shingles > 0")
    classes = filled.groupBy("n_shingles", "high", "low").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("copies"))
    members = filled.join(classes.hint("merge"), ["n_shingles", "high", "low"]).select("row", F.col("first.row").alias("node"))
    members = materialize(members, "classes")
    heads = members.filter("row = node").select("row")
    places = seen.select("row", "n_shingles", F.explode("keys").alias("key")).join(heads.hint("merge"), "row", "left_semi")
    sizes = places.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    places = materialize(places.join(sizes.hint("merge"), "key"), "buckets")

    central = places.groupBy("row").agg(F.sum("size").alias("weight"))
    weighed = places.join(central.hint("merge"), "row")
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", (-F.col("row")).alias("minus"), "n_shingles")).alias("hub"))
    hubs = hubs.select("key", (-F.col("hub.minus")).alias("hub"), F.col("hub.n_shingles").alias("hub_size"))
    edges = materialize(
        places.join(hubs.hint("merge"), "key").filter(F.col("row") != F.col("hub"))
        .filter(F.expr(f"100 * least(n_shingles, hub_size) >= {percent} * greatest(n_shingles, hub_size)"))
        .select(F.least("hub", "row").alias("a"), F.greatest("hub", "row").alias("b")).distinct(), "candidates",
    )

    bucketed = places.select("row").distinct()
    sets = materialize(_sets(rows.select("row", "text").join(bucketed.hint("merge"), "row", "left_semi"), words), "sets")
    links = materialize(_confirmed(edges, sets, percent), "links")
    found = materialize(components(links), "components")

    open_rows = _open_rows(places, found)
    if not open_rows.isEmpty():
        links = materialize(_left_over_links(open_rows, sets, percent, block), "links")
        if not links.isEmpty():
            star = found.filter("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = materialize(components(star.unionByName(links)), "components")

    # components are named by rows; the name asked for is the smallest doc_id in them
    tied = members.join(found.withColumnRenamed("component", "root").hint("merge"), "node", "left").select("row", F.coalesce("root", "node").alias("root"))
    named = seen.select("row", "doc_id", "n_shingles").join(tied.hint("merge"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    named = materialize(named, "named")
    least = named.groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("least"))
    found = named.join(least.hint("merge"), "root").select("row", "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"), (F.col("least.row") == F.col("row")).alias("kept"))
    if not carry:
        return found.drop("row")
    names = {c: k for k, c in held.items()}
    more = rows.select("row", *[F.col(names.get(c, c)).alias(f"own_{k}") for k, c in enumerate(carry)])
    return found.select("row", "n_shingles", "component_id", "kept").join(more.hint("merge"), "row").drop("row").withColumnsRenamed({f"own_{k}": c for k, c in enumerate(carry)})


def dedup(docs: DataFrame, columns: tuple[str, ...], words: int = 5, percent: int = 80) -> DataFrame:
    """``columns`` of one row of each component of near duplicates, the one with the smallest doc_id."""
    own = {f"own_{k}": c for k, c in enumerate(columns)}
    rows = docs.select("doc_id", "text", *[F.col(c).alias(k) for k, c in own.items() if c not in ("doc_id", "text")])
    held = {c: c if c in ("doc_id", "text") else k for k, c in own.items()}
    found = link(rows, words, percent, carry=tuple(held.values())).filter("kept")
    return found.select(*[F.col(held[c]).alias(c) for c in columns])


def _open_rows(places: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components: key, row, n_shingles, component."""
    components = found.select(F.col("node").alias("row"), "component")
    labelled = places.join(components.hint("merge"), "row", "left").withColumn("component", F.coalesce("component", "row"))
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("key")
    return materialize(labelled.join(open_keys.hint("merge"), "key").select("key", "row", "n_shingles", "component"), "open")


def _left_over_links(open_rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) between components in open buckets, as few as tie together what is similar.

    Rows that buckets tie together form a group; it is dealt to blocks by a hash, and each pair
    of blocks is one task's work, so no task holds more than about two blocks of a group.
    """
    edges = open_rows.groupBy("key").agg(F.min("row").alias("first")).join(open_rows.select("key", "row").hint("merge"), "key")
    groups = components(edges.select(F.col("first").alias("a"), F.col("row").alias("b"))).withColumnRenamed("node", "row").withColumnRenamed("component", "group")
    groups = materialize(groups, "groups")
    n_blocks = groups.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = open_rows.select("row", "n_shingles", "component").distinct().join(groups.hint("merge"), "row").join(n_blocks.hint("merge"), "group")
    placed = sets.join(rows.hint("merge"), "row").withColumn("mine", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "group", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "row", "n_shingles", "component", "set",
    )

    def compare(group: pa.Table) -> pa.Table:
        x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
        mine = group.column("mine").to_numpy()
        row, size, part = (group.column(c).to_numpy() for c in ("row", "n_shingles", "component"))
        held = [np.frombuffer(s.as_buffer(), np.uint64) for s in group.column("set").combine_chunks()]
        slots = np.stack([signature(s) for s in held]).astype(np.uint32)
        parent = {int(p): int(p) for p in np.unique(part)}

        def root(p: int) -> int:
            while parent[p] != p:
                parent[p] = p = parent[parent[p]]
            return p

        first, second = np.flatnonzero(mine == x), np.flatnonzero(mine == y)
        a, b = [], []
        for i in first:
            js = second[row[second] > row[i]] if x == y else second
            js = js[(part[js] != part[i]) & (100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i]))]
            same = slots[js] == slots[i]
            shared = same.reshape(len(js), BANDS, ROWS).all(axis=2).any(axis=1)
            for j in js[shared]:
                p, q = root(int(part[i])), root(int(part[j]))
                if p == q:
                    continue
                common = len(np.intersect1d(held[i], held[j], assume_unique=True))
                if 100 * common >= percent * (len(held[i]) + len(held[j]) - common):
                    parent[p] = q
                    a.append(int(min(row[i], row[j])))
                    b.append(int(max(row[i], row[j])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("group", "x", "y").applyInArrow(compare, "a bigint, b bigint").distinct()
