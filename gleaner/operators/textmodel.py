"""Term weights, content profiles and content-based prediction, all in long form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import text as text_functions
from gleaner.functions.similarity import set_cosine
from gleaner.operators.skew import hot_keys, hot_table, skew_join
from gleaner.session import written

PROFILE_WORDS = 200
TOP_WORDS = 30
TEXT_BYTES = 4 << 20  # texts whose words are counted together
COMMON_WORDS = 500_000  # fewer words than this are broadcast; each of the others has at most this share of the rows


def _best(rows: DataFrame, group: str, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; each task keeps ``k`` per group before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= k)


def score_rank(score: Column) -> Column:
    """Scores equal to twelve places tie, so that word order decides and not the last bit."""
    return F.round(score, 12)


def tf(texts: DataFrame, key: str, stopwords: list[str], min_len: int = 4, min_count: int = 4) -> DataFrame:
    """``key, word, tf``: share of the key's kept words.

    A key that has words seen at least ``min_count`` times lists only those; the share is of all its words.
    """
    word = F.col("word")
    listed = (
        text_functions.starts_with_letter(word) & (F.length(word) >= min_len) & ~word.isin(stopwords)
    )
    counts = _word_counts(texts, key, listed)
    totals = counts.groupBy(key).agg(
        F.sum("n").alias("total"), F.max("n").alias("most"), F.count("*").alias("_n")
    )
    kept = (F.col("n") >= min_count) | (F.col("most") < min_count)
    return skew_join(counts, totals.drop("_n"), key, counts=totals.select(key, "_n")).filter(kept).select(
        key, "word", (F.col("n") / F.col("total")).alias("tf")
    )


def _word_counts(texts: DataFrame, key: str, listed: Column | None = None) -> DataFrame:
    """``key, word, n``, written out: the text is read and split once."""
    found = texts.select(
        key, F.explode(text_functions.words(F.lower("text"))).alias("word")
    )
    kept = found if listed is None else found.filter(listed)
    return written(kept.groupBy(key, "word").agg(F.count("*").alias("n")), "word-counts")


def _by_repeats(texts: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key no other row has, and the others (None if there are none)."""
    rows = texts.select(key, "text")
    repeated = hot_keys(rows, key, 1)
    if not isinstance(repeated, DataFrame) and not repeated:
        return rows, None
    again = hot_table(rows, [key], repeated).select(F.col(key).alias("_again"))
    same = F.col(key).eqNullSafe(F.col("_again"))
    return rows.join(again, same, "left_anti"), rows.join(again, same, "left_semi")


def _counted(stopwords: list[str], k: int | None, names: list[str]):
    """Function of a task's batches of keys and texts, words parted by blanks: the counts of each row's listed words."""

    def counts(keys: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy()
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy())
        word = pc.not_equal(words, "").to_numpy(zero_copy_only=False)[code]
        pair, n = np.unique(row[word] * len(words) + code[word], return_counts=True)
        row, code = np.divmod(pair, max(len(words), 1))
        total = np.bincount(row, n, len(texts))[row]
        unlisted = pc.or_(
            pc.is_in(words, value_set=pa.array(stopwords, pa.string())),
            pc.match_substring_regex(words, text_functions.NUMBER),
        )
        kept = np.flatnonzero(~unlisted.to_numpy(zero_copy_only=False)[code])
        if k is not None:
            place = np.empty(len(words), np.int64)
            place[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
            kept = kept[np.lexsort((place[code[kept]], -n[kept], row[kept]))]
            before = np.arange(len(kept)) - np.searchsorted(row[kept], row[kept])
            kept = kept[before < k]
        columns = [keys.take(pa.array(row[kept])), words.take(pa.array(code[kept])), pa.array(n[kept]), pa.array(n[kept] / total[kept])]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        for batch in batches:
            yield counts(batch.column(0), batch.column(1))

    return run


def _counts_of_rows(texts: DataFrame, key: str, stopwords: list[str], k: int | None = None) -> DataFrame:
    """``key, word, n, tf`` of each row by itself, without a shuffle; with ``k`` its most frequent words, ties by word."""
    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES))
    plain = F.coalesce(text_functions.plain(F.lower("text")), F.lit(""))
    schema = T.StructType([
        T.StructField(key, texts.schema[key].dataType), T.StructField("word", T.StringType()),
        T.StructField("n", T.LongType()), T.StructField("tf", T.DoubleType()),
    ])
    return texts.select(key, plain.alias("_plain")).mapInArrow(_counted(stopwords, k, schema.names), schema)


def document_tf(texts: DataFrame, key: str, stopwords: list[str]) -> DataFrame:
    """``key, word, n, tf``: share of all words of the text; stop words and numbers are not listed.

    Rows of a key that stands once are counted where they are read; only those of repeated keys are shuffled.
    """
    alone, again = _by_repeats(texts, key)
    found = _counts_of_rows(alone, key, stopwords)
    if again is None:
        return found
    listed = ~F.col("word").isin(stopwords) & ~F.col("word").rlike(text_functions.NUMBER)
    # a struct of a null key equals another: the texts without a key are one
    counts = _word_counts(again.select(F.struct(key).alias("_key"), "text"), "_key")
    totals = counts.groupBy("_key").agg(F.sum("n").alias("total"), F.count("*").alias("_n"))
    weighed = skew_join(counts.filter(listed), totals.drop("_n"), "_key", counts=totals.select("_key", "_n"))
    tf = (F.col("n") / F.col("total")).alias("tf")
    return found.unionByName(weighed.select(F.col("_key")[key].alias(key), "word", "n", tf))


def doc_top_words(texts: DataFrame, key: str, stopwords: list[str], k: int) -> DataFrame:
    """``key, word, n``: the ``k`` most frequent words of each text, ties by word.

    Rows of a key that stands once are ranked where they are read; only those of repeated keys are shuffled.
    """
    alone, again = _by_repeats(texts, key)
    found = _counts_of_rows(alone, key, stopwords, k).drop("tf")
    if again is None:
        return found
    words = again.select(key, F.explode(text_functions.words(F.lower("text"))).alias("word"))
    listed = words.filter(~F.col("word").isin(stopwords) & ~F.col("word").rlike(text_functions.NUMBER))
    counts = listed.groupBy(key, "word").agg(F.count("*").alias("n"))
    return found.unionByName(_best(counts, key, [F.desc("n"), F.col("word")], k).drop("rank"))


def _document_frequency(weights: DataFrame) -> DataFrame:
    return weights.groupBy("word").agg(F.count("*").alias("df"))


def idf(weights: DataFrame, n_docs: int) -> DataFrame:
    """``word, idf``: ``ln(n_docs / number of keys that list the word)``."""
    return _document_frequency(weights).select("word", F.ln(F.lit(float(n_docs)) / F.col("df")).alias("idf"))


def tfidf(weights: DataFrame, n_docs: int, key: str) -> DataFrame:
    """``key, word, score``

    The words of more than a share of the rows travel to all tasks, fewer than ``COMMON_WORDS`` of them, so that their rows,
    most of all, stay where they are; the rows of the others are joined by word.
    """
    frequency = written(_document_frequency(weights), "document-frequency")
    rows = frequency.agg(F.sum("df")).first()[0] or 0
    common = F.col("df") > rows / COMMON_WORDS
    inverse = F.ln(F.lit(float(n_docs)) / F.col("df")).alias("idf")
    often = F.broadcast(frequency.filter(common).select("word", inverse))  # < COMMON_WORDS rows
    seldom = frequency.filter(~common).select("word", inverse)
    rest = weights.join(often, "word", "left_anti").join(seldom, "word")
    return weights.join(often, "word").unionByName(rest).select(key, "word", (F.col("tf") * F.col("idf")).alias("score"))


def tfidf_profile(scores: DataFrame, key: str, k: int = PROFILE_WORDS, order: str = "asc") -> DataFrame:
    """``key, word, rank``: ``k`` words per key by score, lowest first unless ``order="desc"``; ties by word."""
    score = score_rank(F.col("score"))
    return _best(scores, key, [score.asc() if order == "asc" else score.desc(), F.col("word")], k).select(
        key, "word", "rank"
    )


def tfidf_top(scores: DataFrame, key: str, k: int = TOP_WORDS) -> DataFrame:
    """``key, word, score``: the ``k`` highest scores above 0 per key."""
    above = scores.filter(F.col("score") > 0)
    return _best(above, key, [score_rank(F.col("score")).desc(), F.col("word")], k).drop("rank")


def user_profile(reviews: DataFrame, profile: DataFrame) -> DataFrame:
    """``user_id, word``: words of the profiles of all businesses a user reviewed."""
    visits = reviews.select("user_id", "business_id").distinct()
    words = profile.select("business_id", "word")
    return skew_join(visits, words, "business_id").select("user_id", "word").distinct()


def content_predict(
    test: DataFrame, users: DataFrame, profile: DataFrame, min_sim: float = 0.01
) -> DataFrame:
    """``user_id, business_id, sim``: set cosine of the two word sets; pairs with an unknown id are dropped."""
    pairs = test.select("user_id", "business_id").distinct()
    user_size = users.groupBy("user_id").agg(F.count("*").alias("user_words"))
    business_size = profile.groupBy("business_id").agg(F.count("*").alias("business_words"))
    known = skew_join(skew_join(pairs, user_size, "user_id"), business_size, "business_id")
    # a business profile has at most PROFILE_WORDS words, so each pair becomes that many rows at most
    wanted = skew_join(known, profile.select("business_id", "word"), "business_id")
    common = wanted.join(users, ["user_id", "word"], "left_semi")
    scored = common.groupBy("user_id", "business_id", "user_words", "business_words").agg(F.count("*").alias("n"))
    sim = set_cosine(F.col("n"), F.col("user_words"), F.col("business_words"))
    return scored.select("user_id", "business_id", sim.alias("sim")).filter(F.col("sim") >= min_sim)


def profile_model(profile: DataFrame, users: DataFrame, tokens: DataFrame) -> DataFrame:
    """``description, id, token``: both profiles as one table of word tokens."""
    coded = tokens.select(F.col("id").alias("word"), "token")
    business = skew_join(profile.select(F.col("business_id").cast("string").alias("id"), "word"), coded, "word")
    user = skew_join(users.select(F.col("user_id").cast("string").alias("id"), "word"), coded, "word")
    return business.select(F.lit("business_profile").alias("description"), "id", "token").unionByName(
        user.select(F.lit("user_profile").alias("description"), "id", "token")
    )
