"""Every operator as a query over the test tables.

Trips, flights and tagged posts are not among the tables; the frames built here
give real rows the columns those jobs read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkkit.functions import tokens
from sparkkit.functions.cleaning import number
from sparkkit.operators import grouping, logistic, mixture, quantiles, ranking, regression, vocabulary
from sparkkit.plans import customers, documents, flights, posts, taxi
from sparkkit.session import materialize, new_path
from sparkkit.sources import delimited, schemas, sinks, tagged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Fits at the operators' defaults, which no unrolled SQL can follow; tested against a brute-force version.
FULL_FITS: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def full_fit(fn: Query) -> Query:
    FULL_FITS[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name).cast("double"), digits) for name in names})


def long_ints(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("bigint") for name in names})


# --- stand-ins -------------------------------------------------------------


def star_customer(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey")
    )


def star_orders(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey")
    )


def star_lineitem(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_suppkey").alias("suppkey"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def star_supplier(spark, folder):
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("suppkey"), F.col("s_nationkey").alias("nationkey")
    )


def order_lines(spark, folder):
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips, with zero, unparsable and empty fields among them."""
    line = F.col("l_linenumber")
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    pickup = F.timestamp_add("HOUR", (line * 5 + quantity.cast("int")) % 24, F.col("o_orderdate"))
    discount = F.col("l_discount")
    fields = {
        "medallion": F.col("l_suppkey").cast("string"),
        "hack_license": F.col("o_custkey").cast("string"),
        "pickup_datetime": pickup,
        "trip_time_in_secs": F.when(line == 7, 0.0).otherwise(quantity * 60),
        "trip_distance": F.when(discount == 0, 0.0).when(discount == 0.01, float("nan")).otherwise(quantity + 0.5),
        "payment_type": F.when(F.col("l_returnflag") == "A", "CSH").when(F.col("l_returnflag") == "R", "CRD").otherwise(
            "UNK"
        ),
        "fare_amount": price / 1000,
        "surcharge": F.col("l_tax") * 10,
        "field_13": F.when(F.col("l_tax") == 0.08, "").otherwise("x"),
        "tip": price * F.col("l_tax") / 100,
        "tolls": discount * 100,
        "total_amount": price / 900,
    }
    return order_lines(spark, folder).select(*(fields.get(n, F.lit("x")).alias(n) for n in schemas.TRIP.names))


def flight_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as flights: carrier = order priority, delay = days from order to shipment."""
    day = F.to_date("o_orderdate")
    return order_lines(spark, folder).select(
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.col("o_orderpriority").alias("airline"),
        F.col("l_suppkey").alias("origin_airport"),
        F.col("o_custkey").alias("destination_airport"),
        F.datediff(F.to_date("l_shipdate"), day).alias("departure_delay"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("cancelled"),
    )


def airports(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("iata_code"), F.col("n_name").alias("state")
    )


def docs(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the class ``label`` (1 for English)."""
    english = F.when(F.col("lang") == "en", 1).otherwise(0)
    return table(spark, folder, "documents").select("doc_id", "text", "lang", "source", english.alias("label"))


def tagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as text files of tagged lines whose id is a path ``corpus/language/number``."""
    value = F.concat(
        F.lit('<doc id="corpus/'), "lang", F.lit("/"), F.col("doc_id").cast("string"),
        F.lit('" url="http://e/'), F.col("doc_id").cast("string"), F.lit('" title="'), "source", F.lit('">'),
        F.regexp_replace("text", "[\\r\\n]", " "), F.lit("</doc>"),
    )
    path = new_path(spark, "tagged")
    table(spark, folder, "documents").select(value).write.text(path)
    return delimited.read_lines(spark, path)


def links(spark: SparkSession, folder: str) -> DataFrame:
    """(document, category) rows: every document stands under its source and its language."""
    return table(spark, folder, "documents").select(
        "doc_id", F.explode(F.array("source", "lang")).alias("category")
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a label row: the training split."""
    return docs(spark, folder).join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")


def unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    return docs(spark, folder).join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")


# --- sources and sinks -----------------------------------------------------


@query
def delimited_roundtrip(spark, folder):
    """Orders as pipe text with three leading lines per file, read back and typed."""
    path = new_path(spark, "orders-text")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    sinks.write_parts(rows, path, "|", top_lines=("made by test", "version|1", "orderkey|custkey|status|price|priority"))
    schema = schemas.text_schema("orderkey", "custkey", "status", "price", "priority")
    read = delimited.read_delimited(spark, path, schema, "|", skip_lines=3)
    read = read.withColumn("priority", delimited.or_default("priority", "none"))
    return delimited.cast_columns(read, {"orderkey": "bigint", "custkey": "bigint", "price": "double"})


@query
def positional_fields(spark, folder):
    """Line items as comma text; chosen positions are picked and reordered."""
    path = new_path(spark, "lineitem-text")
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    sinks.write_parts(rows, path)
    fields = delimited.split_fields(delimited.read_lines(spark, path), ",", min_fields=5)
    picked = delimited.pick_fields(fields, (4, 0, 1), ("flag", "orderkey", "line"))
    return delimited.cast_columns(picked, {"orderkey": "bigint", "line": "bigint"})


@query
def category_links(spark, folder):
    """Quoted links with commas inside, written, read back and joined to the documents."""
    path = new_path(spark, "links")
    named = links(spark, folder).select(
        F.col("doc_id").cast("string"), F.concat("category", F.lit(", of corpus")).alias("category")
    )
    sinks.write_links(named, path)
    read = delimited.cast_columns(delimited.read_links(spark, path), {"doc_id": "bigint"})
    return read.join(docs(spark, folder).select("doc_id", "lang"), "doc_id")


@query
def tagged_header(spark, folder):
    """Tagged lines written as text and parsed back."""
    parsed = tagged.parse_tagged(tagged_lines(spark, folder))
    return parsed.select(
        "doc_id", "url", "title", tagged.group_of("doc_id").alias("category"),
        F.length("text").cast("bigint").alias("chars"),
    )


@query
def header_tags(spark, folder):
    """The header tag of every tagged line."""
    return posts.posts(tagged_lines(spark, folder)).select("doc_id", "header", "category")


@query
def trip_lines(spark, folder):
    """Trips as 17-field comma lines, read back; counts per rule."""
    path = new_path(spark, "trips-text")
    sinks.write_parts(trips(spark, folder), path)
    read = delimited.read_trips(spark, path)
    return read.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(number("trip_distance").isNotNull()).alias("numeric"),
        F.count_if(F.coalesce("field_13", F.lit("")) == "").alias("incomplete"),
    )


@query
def flight_lines(spark, folder):
    """Flights as source lines with one leading line and an empty delay for cancelled ones, read back."""
    path = new_path(spark, "flights-text")
    source = flight_rows(spark, folder)
    delay = F.when(F.col("cancelled") == "0", F.col("departure_delay").cast("string")).otherwise("")
    filled = {name: F.col(name).cast("string") for name in source.columns} | {"departure_delay": delay}
    at = dict(zip(schemas.FLIGHT_POSITIONS, schemas.FLIGHT.names, strict=True))
    fields = [filled.get(at.get(i, ""), F.lit("x")).alias(f"f{i}") for i in range(31)]
    sinks.write_parts(source.select(*fields), path, top_lines=(",".join(f"H{i}" for i in range(31)),))
    read = delimited.read_flights(spark, path)
    sums = read.groupBy("airline").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("departure_delay").alias("delay"),
        F.count_if(flights.cancelled()).alias("cancelled"),
    )
    return long_ints(sums, "flights", "delay", "cancelled")


@query
def report_lines(spark, folder):
    """A small report written as one text file and read back."""
    path = new_path(spark, "report")
    sinks.write_report(grouping.count_by(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"]), path)
    read = delimited.read_delimited(spark, path, schemas.text_schema("flag", "status", "num"))
    return delimited.cast_columns(read, {"num": "bigint"})


# --- trips -----------------------------------------------------------------


@query
def valid_rows(spark, folder):
    """Valid trips per payment type, without and with the test of the time."""
    raw = trips(spark, folder)
    loose = grouping.count_by(taxi.valid_trips(raw), ["payment_type"]).withColumn("rule", F.lit("distance and fare"))
    strict = grouping.count_by(taxi.valid_trips(raw, timed=True), ["payment_type"]).withColumn("rule", F.lit("and time"))
    return loose.unionByName(strict)


@query
def range_filter(spark, folder):
    chosen = taxi.regression_trips(trips(spark, folder))
    return chosen.agg(
        F.count(F.lit(1)).alias("trips"),
        F.min(number("trip_distance")).alias("least_miles"),
        F.max(number("fare_amount")).alias("most_fare"),
    )


@query
def taxis_by_drivers(spark, folder):
    return taxi.taxis_by_drivers(trips(spark, folder))


@query
def drivers_by_money_per_minute(spark, folder):
    return rounded(taxi.drivers_by_money_per_minute(trips(spark, folder)), 6, "per_minute")


@query
def surcharge_by_hour(spark, folder):
    return long_ints(rounded(taxi.surcharge_by_hour(trips(spark, folder)), 6, "per_mile"), "hour")


@query
def payment_shares(spark, folder):
    return rounded(taxi.payment_shares(trips(spark, folder)), 6, "cash", "card")


@query
def card_share_by_hour(spark, folder):
    return long_ints(rounded(taxi.card_share_by_hour(trips(spark, folder)), 6, "share"), "hour")


@query
def drivers_by_money_per_mile(spark, folder):
    return rounded(taxi.drivers_by_money_per_mile(trips(spark, folder)), 6, "per_mile")


@query
def tip_quartiles(spark, folder):
    return rounded(taxi.tip_quartiles(trips(spark, folder)), 6, "q1", "q3")


@query
def tip_outliers(spark, folder):
    return rounded(taxi.tip_outliers(trips(spark, folder)), 6, "tip", "gap")


@query
def value_centre(spark, folder):
    return rounded(quantiles.centre(table(spark, folder, "events"), "value"), 6, "mean", "median")


@query
def value_quartiles(spark, folder):
    return rounded(quantiles.quartiles(table(spark, folder, "events"), "value"), 6, "q1", "q3")


@query
def value_outliers(spark, folder):
    outside = quantiles.fence_outliers(table(spark, folder, "events").select("event_id", "value"), "value")
    return rounded(ranking.top_k(outside, 10, "gap", ["event_id"]), 6, "value", "gap")


@query
def ratio_by_hour(spark, folder):
    """Purchase value over all value per hour of day."""
    events = table(spark, folder, "events").withColumn("hour", F.hour("ts").cast("bigint"))
    money = F.col("value").cast("decimal(18,2)")
    bought = F.when(F.col("event_type") == "purchase", money).otherwise(0)
    return rounded(grouping.ratio_by(events, ["hour"], bought, money, "part"), 6, "part")


@query
def type_share(spark, folder):
    events = table(spark, folder, "events")
    return rounded(grouping.share_of_rows(events, {"errors": F.col("event_type") == "error"}), 6, "errors")


@query
def type_share_by_hour(spark, folder):
    events = table(spark, folder, "events").withColumn("hour", F.hour("ts").cast("bigint"))
    return rounded(grouping.rate_by(events, ["hour"], F.col("event_type") == "error", "errors"), 6, "errors")


@query
def ols(spark, folder):
    return rounded(taxi.fare_line(trips(spark, folder)), 6, "slope", "intercept")


def _trace(descent: regression.Descent, spark: SparkSession) -> DataFrame:
    names = [f"w{i}" for i in range(len(descent.weights))]
    weights = [F.get("weights", F.lit(i)).alias(name) for i, name in enumerate(names)]
    trace = descent.frame(spark).select(F.col("round").cast("bigint").alias("round"), "cost", "rate", *weights)
    return rounded(rounded(trace, 8, "rate", *names), 2, "cost")


@query
def gd_simple(spark, folder):
    return _trace(taxi.fare_descent(trips(spark, folder)), spark)


@query
def gd_multi(spark, folder):
    return _trace(taxi.total_descent(trips(spark, folder)), spark)


@query
def squared_error(spark, folder):
    """Squared error of a fixed line over the regression trips."""
    chosen = taxi.regression_trips(trips(spark, folder))
    guess = number("trip_distance") * 1.5 + 2
    return rounded(regression.sum_of_squares(chosen, number("fare_amount"), guess), 3, "sse")


# --- orders ----------------------------------------------------------------


@query
def top_parts(spark, folder):
    return customers.top_parts(star_lineitem(spark, folder))


@query
def top_customers(spark, folder):
    return customers.top_customers(star_orders(spark, folder), star_lineitem(spark, folder))


@query
def top_customer_suppliers(spark, folder):
    return customers.top_customer_suppliers(star_orders(spark, folder), star_lineitem(spark, folder))


@query
def foreign_only_customers(spark, folder):
    return customers.foreign_only_customers(
        star_customer(spark, folder), star_orders(spark, folder), star_lineitem(spark, folder),
        star_supplier(spark, folder),
    )


@query
def top_nations(spark, folder):
    return customers.top_nations(star_lineitem(spark, folder), star_supplier(spark, folder))


@query
def similar_customers(spark, folder):
    pairs = customers.similar_customers(star_orders(spark, folder), star_lineitem(spark, folder))
    return rounded(pairs, 9, "jaccard")


@query
def co_bought_parts(spark, folder):
    return customers.co_bought_parts(star_orders(spark, folder), star_lineitem(spark, folder))


@query
def co_bought_parts_once(spark, folder):
    return customers.co_bought_parts(star_orders(spark, folder), star_lineitem(spark, folder), distinct=True)


@query
def full_order_lines(spark, folder):
    lines = customers.lines_per_order(star_orders(spark, folder), star_lineitem(spark, folder))
    return long_ints(lines, "known", "lines")


@query
def status_share(spark, folder):
    """Part of each line status among the line items of a return flag."""
    counts = grouping.count_by(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])
    return ranking.share_in_group(counts, ["l_returnflag"], "num")


# --- flights ---------------------------------------------------------------


@query
def origins(spark, folder):
    return flights.origins(flight_rows(spark, folder))


@query
def routes(spark, folder):
    return flights.routes(flight_rows(spark, folder))


@query
def worst_delay_january(spark, folder):
    return long_ints(flights.worst_airport_in_january(flight_rows(spark, folder)), "departure_delay")


@query
def worst_delay_weekend(spark, folder):
    return long_ints(flights.worst_carrier_on_weekends(flight_rows(spark, folder)), "departure_delay")


@query
def most_cancelled(spark, folder):
    return flights.most_cancelled_airport(flight_rows(spark, folder))


@query
def cancel_ratio(spark, folder):
    return flights.cancel_ratio(flight_rows(spark, folder))


@query
def max_delay(spark, folder):
    return long_ints(flights.max_delay(flight_rows(spark, folder)), "max_delay")


@query
def max_delay_month(spark, folder):
    return long_ints(flights.max_delay(flight_rows(spark, folder), "airline", "month"), "month", "max_delay")


@query
def avg_delay(spark, folder):
    return flights.mean_delay(flight_rows(spark, folder))


@query
def avg_delay_month(spark, folder):
    return long_ints(flights.mean_delay(flight_rows(spark, folder), "airline", "month"), "month")


@query
def avg_delay_known(spark, folder):
    """Mean delay where cancelled flights have none and are left out."""
    known = F.when(~flights.cancelled(), F.col("departure_delay"))
    rows = flight_rows(spark, folder).withColumn("departure_delay", known)
    return flights.mean_delay(rows, missing="ignore")


@query
def worst_cancel_date(spark, folder):
    return long_ints(flights.worst_cancel_date(flight_rows(spark, folder)), "year", "month", "day")


@query
def flights_by_state_carrier(spark, folder):
    return flights.flights_by_state_and_carrier(flight_rows(spark, folder), airports(spark, folder))


@query
def state_delays(spark, folder):
    return flights.state_delays(flight_rows(spark, folder), airports(spark, folder))


@query
def worst_state(spark, folder):
    return flights.worst_state(flight_rows(spark, folder), airports(spark, folder))


# --- documents -------------------------------------------------------------


def _words(spark, folder) -> DataFrame:
    """The dictionary, stored because a query reads it more than once."""
    return materialize(vocabulary.dictionary(docs(spark, folder)), "dictionary")


@query
def word_count(spark, folder):
    return vocabulary.word_count(docs(spark, folder))


@query
def dictionary(spark, folder):
    return long_ints(vocabulary.dictionary(docs(spark, folder)), "pos")


@query
def doc_freq(spark, folder):
    return long_ints(vocabulary.document_frequency(docs(spark, folder), _words(spark, folder)), "pos")


@query
def tf(spark, folder):
    counts = vocabulary.counted_terms(docs(spark, folder), _words(spark, folder))
    return long_ints(vocabulary.term_frequency(counts), "pos")


@query
def idf(spark, folder):
    corpus = docs(spark, folder)
    frequency = vocabulary.document_frequency(corpus, _words(spark, folder))
    return long_ints(rounded(vocabulary.inverse_frequency(frequency, corpus.count()), 9, "idf"), "pos")


@query
def tfidf(spark, folder):
    corpus = docs(spark, folder)
    vectors = vocabulary.tfidf(corpus, _words(spark, folder), corpus.count())
    return long_ints(rounded(vectors.select("doc_id", "pos", "tfidf"), 9, "tfidf"), "pos")


@query
def avg_tf_by_class(spark, folder):
    chosen = ["the", "and", "des", "und", "los"]
    averages = vocabulary.average_frequency(docs(spark, folder), _words(spark, folder), chosen, "lang")
    return rounded(averages, 9, "avg_tf")


@query
def court_averages(spark, folder):
    """Average term frequencies with the class told by the start of the id, English texts in the place of court cases."""
    corpus, words = docs(spark, folder), _words(spark, folder)
    named = F.concat(F.when(F.col("lang") == "en", documents.COURT_PREFIX).otherwise("W"), F.col("doc_id").cast("string"))
    averages = documents.court_averages(corpus.select(named.alias("doc_id"), "text"), words)
    return long_ints(rounded(averages, 9, "avg_tf"), "label")


@query
def first_words(spark, folder):
    """The first hundred words in the order of the alphabet, with their counts."""
    return vocabulary.word_count(docs(spark, folder)).orderBy("word").limit(100)


@query
def knn_vote(spark, folder):
    return _vote(spark, folder, "dot")


@query
def knn_vote_cosine(spark, folder):
    return _vote(spark, folder, "cosine")


def _vote(spark, folder, metric):
    """Every benchmark text asks."""
    asked = table(spark, folder, "benchmark").select(F.col("item_id").alias("query"), "text")
    return documents.vote_all(docs(spark, folder), links(spark, folder), asked, metric=metric)


@query
def labelled_docs(spark, folder):
    return labelled(spark, folder).select("doc_id", "lang", "label")


@query
def doc_union(spark, folder):
    both = documents.both_splits(labelled(spark, folder), unlabelled(spark, folder))
    return grouping.count_by(both, ["split", "label"])


# --- posts -----------------------------------------------------------------


@query
def tokens_trimmed(spark, folder):
    lines = posts.posts(tagged_lines(spark, folder))
    return vocabulary.word_count(lines, tokeniser=tokens.explode_trimmed)


@query
def tokens_strict(spark, folder):
    lines = posts.posts(tagged_lines(spark, folder))
    return vocabulary.word_count(lines, tokeniser=tokens.explode_strict)


def _post_frames(spark, folder):
    lines = posts.posts(tagged_lines(spark, folder))
    return lines, materialize(posts.post_dictionary(lines), "dictionary")


@query
def sparse_counts(spark, folder):
    """Count maps of all posts, positions under 100, as text."""
    lines, words = _post_frames(spark, folder)
    maps = vocabulary.count_map(posts.post_counts(lines, words), below=100)
    entry = F.transform(
        F.array_sort(F.map_entries("counts")), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))
    )
    return maps.select("doc_id", F.concat_ws(",", entry).alias("counts"))


def _language_model(spark, folder):
    """Term rows of the documents, and class and word weights with one smoothed class per language."""
    corpus, words = docs(spark, folder), _words(spark, folder)
    counts = materialize(vocabulary.term_rows(corpus, words, keep=["lang"]), "term-rows")
    per_word = vocabulary.long_form(counts).groupBy("lang", "pos").agg(F.sum("cnt").alias("n"))
    totals = {row.lang: row.n for row in per_word.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    sizes = {row.lang: row.num for row in grouping.count_by(corpus, ["lang"]).collect()}
    size, every = words.count(), sum(sizes.values())
    total = F.create_map(*(F.lit(v) for pair in totals.items() for v in pair))
    grid = words.select("pos", F.explode(F.array(*(F.lit(name) for name in totals))).alias("lang"))
    seen = F.coalesce("n", F.lit(0)) + 0.1
    weights = grid.join(per_word, ["lang", "pos"], "left").select(
        F.col("lang").alias("cluster"), "pos", (seen / (F.element_at(total, F.col("lang")) + 0.1 * size)).alias("mu")
    )
    shares = {name: n / every for name, n in sorted(sizes.items())}
    return counts, words, weights, shares


@query
def mixture_posterior(spark, folder):
    """Posterior over languages under smoothed word weights of each language."""
    counts, _, weights, shares = _language_model(spark, folder)
    frame = spark.createDataFrame(list(shares.items()), "cluster string, share double")
    priors = frame.select("cluster", F.ln("share").alias("log_pi"))
    logs = weights.select("cluster", "pos", F.ln("mu").alias("log_mu"))
    return rounded(mixture.posterior(vocabulary.long_form(counts).select("doc_id", "pos", "cnt"), logs, priors, docs=docs(spark, folder)), 6, "p")


def _language_state(weights, shares, size) -> mixture.MixtureState:
    """The language model as sampler state: one row of word weights per language, in name order."""
    order = {name: i for i, name in enumerate(shares)}
    mu = np.zeros((len(shares), size))
    table = weights.toPandas()
    mu[table.cluster.map(order).to_numpy(), table.pos.to_numpy()] = table.mu.to_numpy()
    return mixture.MixtureState(np.array(list(shares.values())), mu, seed=7)


@query
def mixture_draw(spark, folder):
    """One draw of a cluster per document under the language model."""
    counts, words, weights, shares = _language_model(spark, folder)
    state = _language_state(weights, shares, words.count())
    return long_ints(mixture.assignments(mixture.document_rows(counts), state), "cluster")


@query
def mixture_sweep(spark, folder):
    """Word counts and sizes of the clusters after one draw."""
    counts, words, weights, shares = _language_model(spark, folder)
    state = _language_state(weights, shares, words.count())
    return long_ints(mixture.sweep(mixture.document_rows(counts), state), "cluster", "pos", "n")


def _weights(spark, state) -> DataFrame:
    """All weights of a state: ``cluster, pos, weight``, class weights at position -1."""
    clusters, size = state.mu.shape
    table = pd.DataFrame({
        "cluster": np.repeat(np.arange(clusters), size + 1), "pos": np.tile(np.arange(-1, size), clusters),
        "weight": np.column_stack([state.pi, state.mu]).ravel(),
    })
    return rounded(spark.createDataFrame(table, "cluster bigint, pos bigint, weight double"), 9, "weight")


@query
def mixture_start(spark, folder):
    """The sampler's start: class and word weights of 20 clusters drawn from their priors, one word weight per dictionary word."""
    return _weights(spark, mixture.initial_state(spark, 20, _words(spark, folder).count(), seed=7))


@query
def mixture_weights(spark, folder):
    """Class and word weights drawn after one draw of a cluster per document under the language model."""
    counts, words, weights, shares = _language_model(spark, folder)
    state = _language_state(weights, shares, words.count())
    return _weights(spark, mixture.next_state(mixture.document_rows(counts), state))


@query
def language_words(spark, folder):
    """Heaviest words of every language under its smoothed weights."""
    _, words, weights, _ = _language_model(spark, folder)
    named = weights.join(F.broadcast(words.select("word", "pos")), "pos").select("cluster", "word", "mu")
    return rounded(ranking.top_k_per_group(named, ["cluster"], 50, "mu", ["word"]), 9, "mu")


@query
def drawn_categories(spark, folder):
    """Commonest languages of every drawn cluster with their shares."""
    counts, words, weights, shares = _language_model(spark, folder)
    state = _language_state(weights, shares, words.count())
    drawn = mixture.assignments(mixture.document_rows(counts), state)
    named = drawn.join(docs(spark, folder).select("doc_id", "lang"), "doc_id")
    return long_ints(mixture.top_categories(named, "lang"), "cluster")


def _clusters(spark, folder):
    """The sampler at its defaults: 20 clusters, 200 rounds."""
    lines, words = _post_frames(spark, folder)
    state, assigned = posts.cluster(lines, words, seed=7)
    return lines, words, state, assigned


@query
def mixture_clusters(spark, folder):
    return _clusters(spark, folder)[3]


@query
def cluster_words(spark, folder):
    _, words, state, _ = _clusters(spark, folder)
    return posts.cluster_words(state, words)


@query
def cluster_categories(spark, folder):
    lines, _, _, assigned = _clusters(spark, folder)
    return posts.cluster_categories(assigned, lines)


# --- classification --------------------------------------------------------


def _fixed_coefficients(words: DataFrame) -> DataFrame:
    """A known coefficient for every position, to test prediction without training."""
    return words.select("pos", ((F.col("pos") * 7919 % 101 - 50) / 50.0).alias("coefficient"))


def _fixed_scores(spark, folder) -> DataFrame:
    corpus, words = docs(spark, folder), _words(spark, folder)
    rows = vocabulary.tfidf_rows(corpus, words, corpus.count(), keep=["label"])
    return logistic.linear_scores(rows, _fixed_coefficients(words), "label")


@query
def logit_predict(spark, folder):
    predicted = logistic.predict(_fixed_scores(spark, folder))
    return long_ints(rounded(predicted.select("doc_id", "chance", "predicted"), 9, "chance"), "predicted")


@query
def logit_loss(spark, folder):
    return rounded(logistic.log_loss(_fixed_scores(spark, folder), "label"), 6, "loss")


@query
def logit_eval(spark, folder):
    counts = logistic.confusion(logistic.predict(_fixed_scores(spark, folder)), "label")
    return rounded(logistic.f1(counts), 9, "precision", "recall", "f1")


@query
def logit_false_positives(spark, folder):
    predicted = logistic.predict(_fixed_scores(spark, folder))
    pages = docs(spark, folder).select(
        "doc_id", F.concat(F.lit("http://e/"), F.col("doc_id").cast("string")).alias("url")
    )
    return logistic.false_positives(predicted, pages, "label")


def _fit(spark, folder, **options):
    corpus, words = docs(spark, folder), _words(spark, folder)
    rows = logistic.sparse_rows(vocabulary.tfidf_rows(corpus, words, corpus.count(), keep=["label"]), "label")
    return logistic.fit(rows, vocabulary.DICTIONARY_SIZE, **options), words


@query
def logit_two_rounds(spark, folder):
    """Coefficients of the dictionary words after two rounds."""
    model, words = _fit(spark, folder, rounds=2)
    joined = words.select("word", "pos").join(F.broadcast(model.frame(spark)), "pos")
    return rounded(joined.select("word", "coefficient"), 9, "coefficient")


@query
def logit_trace(spark, folder):
    """Loss, rate and step length of the first rounds."""
    trace = _fit(spark, folder, rounds=8)[0].trace_frame(spark)
    return long_ints(rounded(trace, 6, "loss", "rate", "step"), "round")


@query
def logit_top_words(spark, folder):
    model, words = _fit(spark, folder, rounds=8)
    return rounded(documents.strongest_words(model, words), 6, "coefficient")


@query
def logit_split_eval(spark, folder):
    """Fit on the labelled documents, evaluate on all others."""
    _, predicted = documents.classify(labelled(spark, folder), unlabelled(spark, folder), rounds=8)
    return rounded(logistic.f1(logistic.confusion(predicted, "label")), 9, "precision", "recall", "f1")


@full_fit
def logit_full_coefficients(spark, folder):
    """Coefficients of the dictionary words after 400 rounds or the stop rule."""
    model, words = _fit(spark, folder)
    joined = words.select("word", "pos").join(F.broadcast(model.frame(spark)), "pos")
    return rounded(joined.select("word", "coefficient"), 9, "coefficient")


@full_fit
def logit_full_trace(spark, folder):
    """Loss, rate and step length of all rounds up to the stop."""
    trace = _fit(spark, folder)[0].trace_frame(spark)
    return long_ints(rounded(trace, 6, "loss", "rate", "step"), "round")


@full_fit
def logit_full_top_words(spark, folder):
    model, words = _fit(spark, folder)
    return rounded(documents.strongest_words(model, words), 6, "coefficient")


@full_fit
def logit_full_split_eval(spark, folder):
    """Fit to the end on the labelled documents, evaluate on all others."""
    _, predicted = documents.classify(labelled(spark, folder), unlabelled(spark, folder))
    return rounded(logistic.f1(logistic.confusion(predicted, "label")), 9, "precision", "recall", "f1")
