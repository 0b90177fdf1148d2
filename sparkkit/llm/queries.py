"""The operators over the whole test tables, with what their contracts ask to return."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.llm import centroids, chat, exact, language, lm, near, packing, periods, pieces, planes, quality, search, toxicity
from sparkkit.llm.common import SPACE, fold
from sparkkit.session import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_sentencepiece(spark, folder):
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = pieces.encode(table(spark, folder, "documents"), model, decoded=True)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_chat(spark, folder):
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_turns(given.unionByName(own)))


@query
def op3_lm_scoring(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold("doc_id") == 1
    deleted = fold("doc_id", 25) < 5  # a fifth of the documents of each of the five folds
    model = lm.fit_words(docs.filter(~held_out), deleted)
    found = lm.score_words(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def toxic_lexicon(spark, docs, folder):
    """The lexicon learned from the labelled rows whose fold is not 0."""
    labels = table(spark, folder, "labels").filter(fold("doc_id") != 0)
    return toxicity.fit(toxicity.sample_labelled(docs, labels))


@query
def op4_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    found = toxicity.score(docs, toxic_lexicon(spark, docs, folder))
    return found.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", "predicted")


@query
def op5_token_planes(spark, folder):
    path = new_path(spark, "planes")
    planes.write_planes(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return planes.read_planes(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query
def op6_exact_dedup(spark, folder):
    digest = F.sha2(exact.normalised("text").cast("binary"), 256)
    return exact.groups(table(spark, folder, "documents"), {"text_sha256": digest})


ORACLE["op6_exact_dedup"] = r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = min(doc_id) OVER same AS kept, sha256(x) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY x)"""


@query
def op7_near_dedup(spark, folder):
    return near.link(table(spark, folder, "documents"), words=2)


@query
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold("doc_id") == 0
    found = language.identify(docs, language.fit(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_quality(spark, folder):
    found = quality.assess(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 9).alias("posterior"))


@query
def op10_packing(spark, folder):
    return packing.piece_rows(packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op11_centroids(spark, folder):
    found = centroids.cluster(table(spark, folder, "embeddings"), k=40, rounds=5, size=64, scale=256, seed="2")
    per = found.inertias()
    written = [",".join(map(str, c)) for c in found.centroids.tolist()]
    rows = [(c, n, sum(per.values()), hashlib.sha256(written[c].encode()).hexdigest()) for c, n in per.items()]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")  # a row per cluster
    return found.members.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds one after another."""
    distance = "list_sum(list_transform(range(1, 65), lambda d: (q[d] - m[d]) * (q[d] - m[d])))"
    steps = [
        r"""v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, q) - 1 AS cluster, q AS m
            FROM (SELECT q, sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h FROM v ORDER BY h, q LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT row, vec_id, q, least.cluster, least.distance FROM (
            SELECT row, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'distance': {distance}, 'cluster': cluster}}) AS least FROM v, c{n} GROUP BY row))""")
        steps.append(f"""u{n} AS (SELECT cluster, d, sum(q[d]) AS s, count(*) AS n FROM a{n}, (SELECT unnest(range(1, 65)) AS d) GROUP BY cluster, d)""")
        steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(new, m) AS m FROM c{n} LEFT JOIN (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d)::BIGINT[] AS new FROM u{n} GROUP BY cluster) USING (cluster))""")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)"""


ORACLE["op11_centroids"] = _centroid_sql()


def _with_copied_stretch(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with repeats written into every tenth text.

    With h the crc32 of the id, g = h / 10 and n words, every word i >= a of a text with h % 10 = 0 becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")

    def written(w):  # a lambda, so that each text is split once
        n = F.size(w)

        def repeated(a):
            p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
            return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p)))

        return F.when(n == 0, w).otherwise(F.transform(F.array((g % n).cast("int")), repeated)[0])

    copied = F.array_join(F.transform(F.array(words), written)[0], " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").isNotNull(), copied).otherwise(F.col("text")).alias("text"))


@query
def op12_runs(spark, folder):
    found = periods.collapse(_with_copied_stretch(table(spark, folder, "documents")), min_length=6, min_exponent=4)
    ahead = "runs[0], (best, r) -> if(r.length * best.period > best.length * r.period, r, best)"  # of equal ones the first stays
    found = found.withColumn("best", F.expr(f"if(size(runs) = 0, null, aggregate(runs, {ahead}))"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    written = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(written.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op13_max_score(spark, folder):
    return search.top_products(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLE["op13_max_score"] = """
    WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.row AS query, a.vec_id AS query_id, b.row, b.vec_id,
                      coalesce(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda d: a.q[d] * b.q[d])), 0)::BIGINT AS score
               FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.row <> b.row)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 5"""
