"""Every operator bound to the given tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.hashing import USER_MINHASH_BUCKETS, minhash_family
from gleaner.operators import bloom, graph, itemsets, numbering, recommend, reviews, similarity, sketch, textmodel
from gleaner.operators.pairs import Need
from gleaner.plans import bindings as b
from gleaner.session import scratch_path, tune, written
from gleaner.sources import readers, writers
from gleaner.streaming import replay, windows
from gleaner.streaming.reservoir import keep_sample, last_sample, tagged, tracked

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _shown(sets: DataFrame) -> DataFrame:
    return sets.withColumn("items", F.array_join("items", "|"))


# --- review statistics ---


def q_review_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.review_stats(b.reviews(spark, sf), b.YEAR)


def q_top_users(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_users(b.reviews(spark, sf), b.TOP)


def q_top_words(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_words(b.texts(spark, sf), b.STOPWORDS, b.TOP)


def q_top_words_full(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.top_words(b.texts(spark, sf), b.STOPWORDS, b.TOP, full_match=True)


def q_category_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(reviews.category_avg(b.reviews(spark, sf), b.business(spark, sf), b.TOP), "stars")


def q_category_avg_all(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(reviews.category_avg(b.reviews(spark, sf), b.business(spark, sf), keep_empty=True), "stars")


def q_popular(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.popular(b.reviews(spark, sf), b.POPULAR_OVER)


def q_partition_stats(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.partition_stats(b.reviews(spark, sf), 8, "custom", F.col("business_id"))


def q_partition_default(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.partition_stats(b.reviews(spark, sf), 2, "default")


def q_semi_state(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.semi_state(b.reviews(spark, sf), b.business(spark, sf), b.STATE)


# --- itemsets ---


def _baskets(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.pairs(spark, sf).withColumnsRenamed({"l_orderkey": "basket_id", "p_brand": "item"})
    return written(rows, "baskets")


def _merged(spark: SparkSession, sf: str, chunk: Column | None = None) -> DataFrame:
    return itemsets.merged(_baskets(spark, sf), chunk)


def q_baskets(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets.baskets(b.pairs(spark, sf), "l_orderkey", "p_brand")


def q_baskets_swapped(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets.baskets(b.pairs(spark, sf), "p_brand", "l_orderkey")


def q_baskets_min(spark: SparkSession, sf: str) -> DataFrame:
    return itemsets.baskets(b.pairs(spark, sf), "l_orderkey", "p_brand", min_size=5)


def _frequent(method: str, max_k: int | None = None, strict: bool = False, sizes: list[int] | None = None) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = (_baskets if method == "fpgrowth" else _merged)(spark, sf)
        support = itemsets.support_count(rows, b.SUPPORT_SHARE)
        found = itemsets.frequent_itemsets(
            rows, support, max_k, strict, method, chunks=b.CHUNKS
        )
        return _shown(found if sizes is None else found.filter(F.col("size").isin(sizes)))

    return query


def q_itemset_candidates(spark: SparkSession, sf: str) -> DataFrame:
    chunk = F.pmod("basket_id", F.lit(b.CHUNKS))
    rows = _merged(spark, sf, chunk)
    support = itemsets.support_count(rows, b.SUPPORT_SHARE)
    return _shown(itemsets.itemset_candidates(rows, support, b.CHUNKS, chunk=chunk))


def q_pcy_buckets(spark: SparkSession, sf: str) -> DataFrame:
    rows = _merged(spark, sf)
    return itemsets.pcy_buckets(rows, itemsets.support_count(rows, b.SUPPORT_SHARE))


def q_multisets3(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(itemsets.multiset_baskets(b.multi_pairs(spark, sf), "l_orderkey", "p_brand"), "multi-baskets")
    return _shown(itemsets.frequent_multisets(rows, itemsets.support_count(rows, b.SUPPORT_SHARE)))


def q_itemset_report(spark: SparkSession, sf: str) -> DataFrame:
    chunk = F.pmod("basket_id", F.lit(b.CHUNKS))
    rows = _merged(spark, sf, chunk)
    support = itemsets.support_count(rows, b.SUPPORT_SHARE)
    candidates = written(itemsets.itemset_candidates(rows, support, b.CHUNKS, chunk=chunk), "candidates")
    frequent = itemsets.frequent_itemsets(rows, support, method="son", candidates=candidates)
    return itemsets.itemset_report(candidates, frequent)


# --- text model ---


def _tf(spark: SparkSession, sf: str) -> DataFrame:
    return written(textmodel.tf(b.texts(spark, sf), "business_id", b.STOPWORDS), "tf")


def _n_business(spark: SparkSession, sf: str) -> int:
    return b.visits(spark, sf).select("business_id").distinct().count()


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    scores = textmodel.tfidf(_tf(spark, sf), _n_business(spark, sf), "business_id")
    return written(textmodel.tfidf_profile(scores, "business_id"), "profile")


def q_tf(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(textmodel.tf(b.texts(spark, sf), "business_id", b.STOPWORDS), "tf")


def q_idf(spark: SparkSession, sf: str) -> DataFrame:
    weights = textmodel.tf(b.texts(spark, sf), "business_id", b.STOPWORDS)
    return _rounded(textmodel.idf(weights, _n_business(spark, sf)), "idf")


def q_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(textmodel.tfidf(_tf(spark, sf), _n_business(spark, sf), "business_id"), "score")


def q_tfidf_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf)


def q_tfidf_top(spark: SparkSession, sf: str) -> DataFrame:
    texts = b.texts(spark, sf)
    weights = written(textmodel.document_tf(texts, "doc_id", b.STOPWORDS), "document-tf")
    scores = textmodel.tfidf(weights, texts.count(), "doc_id")
    return _rounded(textmodel.tfidf_top(scores, "doc_id"), "score")


def q_doc_top_words(spark: SparkSession, sf: str) -> DataFrame:
    return textmodel.doc_top_words(b.texts(spark, sf), "doc_id", b.STOPWORDS, 20)


def q_user_profile(spark: SparkSession, sf: str) -> DataFrame:
    return textmodel.user_profile(b.visits(spark, sf), _profile(spark, sf))


def q_profile_model(spark: SparkSession, sf: str) -> DataFrame:
    profile = _profile(spark, sf)
    users = textmodel.user_profile(b.visits(spark, sf), profile)
    return textmodel.profile_model(profile, users, numbering.token_dict(profile, "word"))


def _content(spark: SparkSession, sf: str) -> DataFrame:
    profile = _profile(spark, sf)
    users = written(textmodel.user_profile(b.visits(spark, sf), profile), "users")
    return textmodel.content_predict(b.asked(spark, sf), users, profile)


def q_content_predict(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_content(spark, sf), "sim")


def q_hit_rate(spark: SparkSession, sf: str) -> DataFrame:
    found = recommend.hit_rate(b.asked(spark, sf), _content(spark, sf), ["user_id", "business_id"])
    return _rounded(found, "rate")


# --- similarity ---


def _coded(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct reviews as business, user and the dense number of the user."""
    rows = written(b.reviews(spark, sf).select("business_id", "user_id").distinct(), "reviews")
    counts = rows.groupBy("user_id").agg(F.count("*").alias("_n"))
    return written(numbering.encode(rows, numbering.token_dict(rows, "user_id"), "user_id", "token", counts), "coded")


def q_token_dict(spark: SparkSession, sf: str) -> DataFrame:
    return numbering.token_dict(b.reviews(spark, sf), "user_id")


def q_minhash(spark: SparkSession, sf: str) -> DataFrame:
    sigs = similarity.minhash(_coded(spark, sf), "business_id", "token", minhash_family(b.SIM_HASHES))
    return sigs.select("item", F.array_join("sig", " ").alias("sig"))


def q_lsh_buckets(spark: SparkSession, sf: str) -> DataFrame:
    family = minhash_family(b.SIM_HASHES)
    codes = similarity.shared_codes(_coded(spark, sf), "business_id", "token", family, b.SIM_BANDS)
    buckets = similarity.decoded(similarity.code_buckets(codes), family, b.SIM_BANDS)
    return buckets.withColumn("key", F.array_join("key", " "))


def q_lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    family, need = minhash_family(b.SIM_HASHES), Need(1, b.MIN_JACCARD)
    return similarity.coded_candidates(_coded(spark, sf), "business_id", "user_id", "token", family, b.SIM_BANDS, need)


def _jaccard_lsh(spark: SparkSession, sf: str, **how) -> DataFrame:
    return similarity.jaccard_lsh(
        _coded(spark, sf), "business_id", "user_id", "token", minhash_family(b.SIM_HASHES), b.SIM_BANDS, b.MIN_JACCARD, **how
    )


def _jaccard_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(b.reviews(spark, sf).select("business_id", "user_id").distinct(), "reviews")
    return similarity.jaccard_join(rows, "business_id", "user_id", b.MIN_JACCARD)


def q_jaccard_lsh(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_jaccard_lsh(spark, sf, whole=True), "sim")


def q_jaccard_exact(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_jaccard_exact(spark, sf), "sim")


def q_lsh_recall(spark: SparkSession, sf: str) -> DataFrame:
    exact = written(_jaccard_exact(spark, sf), "exact")
    found = _jaccard_lsh(spark, sf, known=exact).agg(F.count("*").alias("found"))
    known = exact.agg(F.count("*").alias("known")).scalar()
    whole = found.withColumn("known", known)
    return whole.withColumn("recall", F.round(F.try_divide("found", "known"), 6))


# --- collaborative filtering ---


def q_ratings_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.ratings_dedup(b.reviews(spark, sf))


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return written(b.train(spark, sf), "train")


def _item_model(spark: SparkSession, sf: str) -> DataFrame:
    return recommend.pearson(_train(spark, sf), "business_id", "user_id")


def _user_model(spark: SparkSession, sf: str) -> DataFrame:
    family = minhash_family(b.SIM_HASHES, USER_MINHASH_BUCKETS)
    return recommend.pearson_lsh(_train(spark, sf), "user_id", "business_id", family, b.SIM_BANDS)


def q_pearson_item(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_item_model(spark, sf), "sim")


def q_pearson_item_corated(spark: SparkSession, sf: str) -> DataFrame:
    found = recommend.pearson(_train(spark, sf), "business_id", "user_id", mean="corated")
    return _rounded(found, "sim")


def q_pearson_user(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(_user_model(spark, sf), "sim")


def q_pearson_user_exact(spark: SparkSession, sf: str) -> DataFrame:
    """The correlations that ``q_pearson_user`` looks for by bands, all of them."""
    return _rounded(recommend.pearson(_train(spark, sf), "user_id", "business_id", min_jaccard=0.01), "sim")


def q_cf_item_predict(spark: SparkSession, sf: str) -> DataFrame:
    train = _train(spark, sf)
    model = recommend.pearson(train, "business_id", "user_id")
    found = recommend.predict_item(
        b.test(spark, sf), train, model, recommend.averages(train, "business_id"), recommend.overall_average(train)
    )
    return _rounded(found, "stars")


def q_cf_user_predict(spark: SparkSession, sf: str) -> DataFrame:
    train = _train(spark, sf)
    family = minhash_family(b.SIM_HASHES, USER_MINHASH_BUCKETS)
    model = recommend.pearson_lsh(train, "user_id", "business_id", family, b.SIM_BANDS)
    found = recommend.predict_user(
        b.test(spark, sf), train, model, recommend.averages(train, "user_id"), recommend.overall_average(train)
    )
    return _rounded(found, "stars")


# --- graph ---


def _min_shared(rows: DataFrame) -> int:
    """A common count well above chance: mean overlap of two users plus three deviations, at least 3."""
    n = rows.count()  # rows are distinct
    users, items = (rows.select(c).distinct().count() for c in ("user_id", "business_id"))
    chance = (n / users) ** 2 / items
    return max(3, math.ceil(chance + 3 * math.sqrt(chance) + 1))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    rows = written(b.reviews(spark, sf).select("user_id", "business_id").distinct(), "rows")
    return graph.cooccur_edges(rows, "user_id", "business_id", _min_shared(rows))


def q_cooccur_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(spark, sf)


def q_graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.nodes(_edges(spark, sf))


def q_communities(spark: SparkSession, sf: str) -> DataFrame:
    return graph.label_propagation(_edges(spark, sf))


def q_community_list(spark: SparkSession, sf: str) -> DataFrame:
    return graph.communities(graph.label_propagation(_edges(spark, sf)))


def q_community_lines(spark: SparkSession, sf: str) -> DataFrame:
    members = written(graph.communities(graph.label_propagation(_edges(spark, sf))), "members")
    return graph.community_lines(members)


# --- sketches and streams ---


def q_bloom_bits(spark: SparkSession, sf: str) -> DataFrame:
    return sketch.bloom_bits(b.bloom_build(spark, sf), "c_name")


def q_bloom_probe(spark: SparkSession, sf: str) -> DataFrame:
    return sketch.bloom_probe(b.bloom_asked(spark, sf), "c_name", sketch.bloom_bits(b.bloom_build(spark, sf), "c_name"))


def _order_filter(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, bloom.Shape]:
    """Orders asked for, the names of finished ones and the shape of their filter."""
    asked = b.order_names(spark, sf)
    keys = asked.filter(F.col("o_orderstatus") == "F").select("name")
    return asked, keys, bloom.shape_for(bloom.count_keys(keys, "name"), b.BLOOM_RATE)


def q_bloom_blocks(spark: SparkSession, sf: str) -> DataFrame:
    _, keys, shape = _order_filter(spark, sf)
    held = bloom.build(keys, "name", shape)
    places = F.sequence(F.lit(0), F.lit(bloom.BLOCK_BITS - 1))
    words = F.array(*[f"w{w}" for w in range(bloom.WORDS)])
    is_set = lambda i: F.getbit(F.get(words, F.shiftright(i, 6)), i.bitwiseAND(F.lit(63))) == 1
    return held.select("block", F.array_join(F.filter(places, is_set).cast("array<string>"), " ").alias("bits"))


def q_bloom_member(spark: SparkSession, sf: str) -> DataFrame:
    asked, keys, shape = _order_filter(spark, sf)
    return bloom.probe(asked.select("o_orderkey", "name"), "name", bloom.build(keys, "name", shape), shape)


def q_bloom_quality(spark: SparkSession, sf: str) -> DataFrame:
    asked, keys, shape = _order_filter(spark, sf)
    flags = bloom.probe(asked.select("name"), "name", bloom.build(keys, "name", shape), shape)
    found = bloom.quality(flags, keys, "name")
    return found.withColumn("within", F.col("wrong") <= b.BLOOM_RATE * F.col("absent"))


def q_fm(spark: SparkSession, sf: str) -> DataFrame:
    return sketch.fm_estimate(b.cities(b.events(spark, sf)), "city")


def q_fm_windows(spark: SparkSession, sf: str) -> DataFrame:
    return windows.fm_windows(b.cities(b.events(spark, sf)), "ts", "city", b.WINDOW, b.SLIDE)


def q_fm_windows_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Exact counts beside the estimates from states that were written per pane and united."""
    rows = b.cities(b.events(spark, sf))
    panes = written(windows.pane_sketches(rows, "ts", "city", b.SLIDE), "panes")
    united = windows.united_windows(panes, b.WINDOW, b.SLIDE)
    whole = windows.fm_windows(rows, "ts", "city", b.WINDOW, b.SLIDE).select("window_start", "exact")
    near = F.abs(F.col("sketched") - F.col("exact")) <= F.greatest(F.lit(2.0), 0.1 * F.col("exact"))
    return whole.join(united, "window_start").select("window_start", "exact", "estimate", near.alias("near"))


def q_fm_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = b.events(spark, sf)
    folder, state, path = (scratch_path(spark, name) for name in ("arrived", "windows-state", "windows"))
    stream = replay.source(spark, folder, events.schema)
    found = windows.fm_windows(b.cities(stream), "ts", "city", b.WINDOW, b.SLIDE, b.WATERMARK)

    def start():
        writer = found.writeStream.outputMode("append").format("parquet").trigger(availableNow=True)
        return writer.option("checkpointLocation", state).start(path)

    last = replay.closing_row(events.filter("event_type <> 'error'"), "ts", b.AFTER_LAST)
    replay.replay([*replay.parts_of(events, "ts", b.REPLAY_PARTS), last], folder, start)
    return spark.read.schema(found.schema).parquet(path)


def q_reservoir_tags(spark: SparkSession, sf: str) -> DataFrame:
    sample = sketch.reservoir(tagged(b.messages(b.events(spark, sf))), "event_id")
    return sketch.tag_counts(sample)


def q_reservoir_stream(spark: SparkSession, sf: str) -> DataFrame:
    events = b.events(spark, sf)
    folder, state, base = (scratch_path(spark, name) for name in ("arrived", "sample-state", "sample"))
    stream = tagged(b.messages(replay.source(spark, folder, events.schema)))
    start = lambda: keep_sample(stream, "event_id", base, state, every=None)
    replay.replay(replay.parts_of(events, "ts", b.REPLAY_PARTS), folder, start)
    sample = last_sample(spark, base, stream.schema, "event_id")
    return sample.select("event_id", F.array_join("tags", "|").alias("tags"))


def q_tracked_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of a sample of the English messages that mention a tracked word."""
    return sketch.tag_counts(sketch.reservoir(tagged(tracked(b.tracked_messages(spark, sf), b.TRACKED)), "id"))


# --- sources and sinks: written to the shared folder and read back ---


def q_json_reviews(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "reviews")
    shown = F.date_format(F.col("date").cast("timestamp"), readers.DATE_FORMAT)
    writers.write_json_lines(b.reviews(spark, sf).withColumn("date", shown), path)
    return reviews.review_stats(readers.read_reviews(spark, path), b.YEAR)


def q_csv_pairs(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pairs")
    writers.write_pairs(b.visits(spark, sf), path)
    return itemsets.baskets(readers.read_pairs(spark, path), "user_id", "business_id")


def q_basket_lines(spark: SparkSession, sf: str) -> DataFrame:
    """How many baskets of a white-space separated file hold each item."""
    path = scratch_path(spark, "basket-lines")
    lists = b.multi_pairs(spark, sf).groupBy("l_orderkey").agg(F.concat_ws(" ", F.collect_list("p_brand")).alias("value"))
    lists.select("value").write.text(path)
    return readers.read_baskets(spark, path).groupBy("item").agg(F.count("*").alias("n"))


def q_stopword_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stopwords")
    spark.createDataFrame([(" ".join(b.STOPWORDS),)], "value string").write.text(path)
    counts = reviews.without_words(reviews.word_counts(b.texts(spark, sf), []), readers.read_stopwords(spark, path))
    return counts.orderBy(F.desc("n"), "word").limit(b.TOP).orderBy("word")


def q_document_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent words of texts read as plain lines."""
    path = scratch_path(spark, "documents")
    b.texts(spark, sf).select("text").write.text(path)
    return reviews.top_words(readers.read_documents(spark, path), b.STOPWORDS, b.TOP)


def q_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The itemset report as ordered text files, read back."""
    path = scratch_path(spark, "report")
    writers.write_ordered(q_itemset_report(spark, sf), path)
    return readers.read_ordered(spark, path)


def q_review_report(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics, top users and top words from a JSON report read back."""
    path = scratch_path(spark, "review-report")
    report = writers.review_report(q_review_stats(spark, sf), q_top_users(spark, sf), q_top_words(spark, sf))
    writers.write_report(report, path)
    kind = "A long, B long, C long, D array<array<string>>, E array<string>"
    read = spark.read.text(path).select(F.from_json("value", kind).alias("r")).select("r.*")
    users = F.transform("D", lambda u: F.concat_ws(":", u))
    return read.select(
        F.col("A").alias("total"), F.col("B").alias("in_year"), F.col("C").alias("users"),
        F.array_join(users, " ").alias("top_users"), F.array_join("E", " ").alias("top_words"),
    )


def q_csv_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of businesses in a state as one ordered CSV over several files, read back with line numbers."""
    path = scratch_path(spark, "csv")
    rows = q_semi_state(spark, sf)
    writers.write_csv_ordered(rows, ["user_id", "business_id"], path)
    return readers.read_csv_ordered(spark, path, rows.schema)


def q_windows_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Windows as an ordered CSV, read back."""
    path = scratch_path(spark, "windows-csv")
    rows = q_fm_windows(spark, sf)
    writers.write_csv_ordered(rows, ["window_start"], path)
    return readers.read_csv_ordered(spark, path, rows.schema)


def q_membership_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "membership")
    writers.write_ordered(writers.membership_lines(q_bloom_probe(spark, sf), "c_custkey"), path)
    return readers.read_ordered(spark, path)


def _stored(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "store")
    writers.write_store(q_profile_model(spark, sf), path)
    return path


def q_model_store(spark: SparkSession, sf: str) -> DataFrame:
    """Token lists of the users' profiles, read from the store of both kinds."""
    users = readers.read_store(spark, _stored(spark, sf), "user_profile")
    return users.groupBy("id").agg(F.count("*").alias("n"), F.min("token").alias("least"), F.max("token").alias("most"))


def q_content_predict_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Content predictions from the stored model alone."""
    path = _stored(spark, sf)
    users = readers.read_store(spark, path, "user_profile").select(F.col("id").cast("long").alias("user_id"), F.col("token").alias("word"))
    profile = readers.read_store(spark, path, "business_profile").select(F.col("id").alias("business_id"), F.col("token").alias("word"))
    return _rounded(textmodel.content_predict(b.asked(spark, sf), users, profile), "sim")


def q_cf_item_predict_ready(spark: SparkSession, sf: str) -> DataFrame:
    """Item-based predictions with averages from a ready JSON file, its entry for unknown ids included."""
    train, path = _train(spark, sf), scratch_path(spark, "averages")
    writers.write_averages(recommend.averages(train, "business_id"), recommend.overall_average(train), path)
    known, unknown = recommend.split_averages(readers.read_averages(spark, path))
    known = known.withColumn("id", F.col("id").cast(train.schema["business_id"].dataType))
    model = recommend.pearson(train, "business_id", "user_id")
    return _rounded(recommend.predict_item(b.test(spark, sf), train, model, known, unknown), "stars")


QUERIES: dict[str, Query] = {
    "q_itemsets": _frequent("levelwise"),
    "q_itemsets_son": _frequent("son"),
    "q_itemsets_fpgrowth": _frequent("fpgrowth"),
    "q_apriori3": _frequent("levelwise", max_k=3, strict=True),
    "q_pcy_pairs": _frequent("pcy", max_k=2, strict=True, sizes=[2]),
    "q_pcy_multi": _frequent("pcy", strict=True),
    **{name: f for name, f in list(globals().items()) if name.startswith("q_")},
}


def _tuned(query: Query) -> Query:
    return lambda spark, sf: query(tune(spark), sf)


def queries() -> dict[str, Query]:
    return {name: _tuned(query) for name, query in QUERIES.items()}
