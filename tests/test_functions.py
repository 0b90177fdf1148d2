import math
import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkkit.functions import scalars, tokens
from sparkkit.functions.cleaning import REGRESSION_BOUNDS, complete, is_number, non_zero, within

TEXTS = st.lists(st.text(alphabet="abZ é3_'.-<>()\n\t   İß", max_size=40), min_size=1, max_size=8)


def exploded(spark, texts, fn):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {i: [] for i in range(len(texts))}
    for row in fn(docs, "text").collect():
        out[row.doc_id].append(row.word)
    return [sorted(out[i]) for i in range(len(texts))]


def letters(text):
    return re.sub("[^a-zA-Z]", " ", text).lower().split()


def trimmed(text):
    return [w for w in (w.strip(".,<>()-[]:;?!") for w in text.lower().split()) if len(w) > 1]


def strict(text):
    found = (w.lower().strip(string.punctuation) for w in text.split(" ") if re.search(r"[A-Za-z]\w+", w))
    return [w for w in found if len(w) > 2]


@pytest.mark.parametrize(
    "mine, plain",
    [(tokens.explode_letters, letters), (tokens.explode_trimmed, trimmed), (tokens.explode_strict, strict)],
)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=TEXTS)
def test_tokenisers_match_plain_python(spark, mine, plain, texts):
    assert exploded(spark, texts, mine) == [sorted(plain(t)) for t in texts]


def test_letters_split_at_apostrophe_and_digit(spark):
    assert exploded(spark, ["Dog; it's 3 birds"], tokens.explode_letters) == [["birds", "dog", "it", "s"]]


def test_number_rules(spark):
    df = spark.createDataFrame(
        [(1, "2.5"), (2, "0"), (3, "nan"), (4, "inf"), (5, ""), (6, "x"), (7, None), (8, "-1e3")], "i int, v string"
    )
    assert {r.i for r in df.where(is_number("v")).collect()} == {1, 2, 8}
    assert {r.i for r in df.where(non_zero(["v"])).collect()} == {1, 8}
    assert {r.i for r in df.where(complete(df, ["v"])).collect()} == {1, 2, 3, 4, 6, 8}


@pytest.mark.parametrize(
    "name, good, bad",
    [
        ("trip_time_in_secs", ("120", "3600"), ("119", "3601", "", "nan")),
        ("fare_amount", ("3", "200"), ("2.99", "200.01")),
        ("trip_distance", ("1", "50"), ("0.99", "50.01")),
        ("tolls", ("3", "1000"), ("2.99", "nan", "inf")),
    ],
)
def test_bounds_are_inclusive(spark, name, good, bad):
    base = {"trip_time_in_secs": "600", "fare_amount": "10", "trip_distance": "2", "tolls": "4"}
    frame = spark.createDataFrame([base | {name: v} for v in good + bad])
    assert sorted(r[name] for r in frame.where(within(REGRESSION_BOUNDS)).collect()) == sorted(good)


def test_typed_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr(
        "cast(id * 100 as double) trip_time_in_secs", "10d fare_amount", "2d trip_distance", "4d tolls"
    ).write.parquet(path)
    chosen = spark.read.parquet(path).where(within(REGRESSION_BOUNDS))
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trip_time_in_secs,120.0)" in plan
    assert chosen.count() == 8


def test_stable_logistic_parts(spark):
    df = spark.createDataFrame([(z,) for z in (-1000.0, -2.0, 0.0, 2.0, 1000.0)], "z double")
    got = df.select(scalars.sigmoid("z").alias("s"), scalars.log1p_exp("z").alias("l")).collect()
    assert [r.s for r in got] == pytest.approx([0, 1 / (1 + math.exp(2)), 0.5, 1 / (1 + math.exp(-2)), 1])
    assert [r.l for r in got] == pytest.approx([0, math.log1p(math.exp(-2)), math.log(2), math.log1p(math.exp(2)), 1000])


def test_array_functions_and_text(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], 12.5)], "a array<double>, b array<double>, p double")
    row = df.select(
        scalars.array_dot("a", "b").alias("dot"), scalars.array_cosine("a", "b").alias("cos"),
        scalars.array_jaccard("a", "b").alias("jac"), scalars.percent_text("p").alias("txt"),
        scalars.indicator("p").alias("one"),
    ).first()
    assert row.dot == 11 and row.jac == 0 and row.txt == "12.5%" and row.one == 1
    assert row.cos == pytest.approx(11 / math.sqrt(5 * 25))


def test_hour_of_text_and_timestamp(spark):
    df = spark.sql("select '2013-01-01 17:05:00' t union all select 'no time'")
    assert {r.h for r in df.select(scalars.hour_of("t").alias("h")).collect()} == {17, None}
    assert spark.sql("select timestamp'2013-01-01 05:00:00' t").select(scalars.hour_of("t").alias("h")).first().h == 5
