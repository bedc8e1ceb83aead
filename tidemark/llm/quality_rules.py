"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio between trusted and raw text. SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import BLANKS, let, small_or_plain, table, words_of

#: Kinds of n-grams and buckets of each kind (a power of 2).
KINDS, BUCKETS = 3, 1 << 14
#: Tokens by which the trusted shares are drawn to the raw ones: with little trusted text all ratios are near 0.
SMOOTHING = 8.0 * BUCKETS
#: Least mean log ratio (nats a feature) of a kept text.
THRESHOLD = -0.16


def _repeat_words(per_word: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text, the first occurrence included.

    ``per_word`` are the words' hashes. Each window is a 64-bit hash of them with its place; after sorting, equal neighbours are repeats, and
    a repeat covers five words less what the next one covers. Texts whose windows all differ skip the sort.
    """

    def windows(h: Column) -> Column:
        at = lambda i, k: F.element_at(h, i + F.lit(k))
        return F.transform(F.sequence(F.lit(1), F.size(h) - 4), lambda i: F.xxhash64(*(at(i, k) for k in range(5))))

    def covered(w: Column) -> Column:
        tagged = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        gaps = lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5)))
        total = lambda g: F.aggregate(g, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
        return let(tagged, lambda s: let(places(s), lambda p: total(gaps(p))))

    counted = let(per_word, lambda h: let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w))))
    return F.when(F.size(per_word) < 5, F.lit(0).cast("bigint")).otherwise(counted)


def base_columns(text: Column, words: Column, per_word: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": _repeat_words(per_word),
    }


def bucket(kind: int, *grams: Column) -> Column:
    """Bucket number of an n-gram of one kind; strings are hashed, and a single hash is taken as it is."""
    h = grams[0] if kind == 0 else F.xxhash64(*grams)
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + kind * BUCKETS


def head(word: Column) -> Column:
    return F.left(word, F.lit(4))


def tail(word: Column) -> Column:
    """Hash of the last three characters."""
    return F.xxhash64(F.right(word, F.lit(3)))


def ratio_sum(words: Column, per_word: Column, ratio: Callable[[Column], Column]) -> Column:
    """Log ratios summed over the whole word stream: every word, every word's first four characters, every pair of word ends."""
    whole = F.aggregate(per_word, F.lit(0.0), lambda acc, h: acc + ratio(bucket(0, h)))
    heads = F.aggregate(words, F.lit(0.0), lambda acc, w: acc + ratio(bucket(1, head(w))))
    at = lambda t, i: F.element_at(t, i)
    pairs = lambda t: F.aggregate(F.sequence(F.lit(2), F.size(t)), F.lit(0.0), lambda acc, i: acc + ratio(bucket(2, at(t, i - 1), at(t, i))))
    return whole + heads + F.when(F.size(words) < 2, F.lit(0.0)).otherwise(let(F.transform(words, tail), pairs))


def fit_ratio(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Counts over all documents and over the trusted ones; one row with the log ratio of every bucket.

    The row has KINDS * BUCKETS doubles whatever the input's size; a bucket that never occurs has 0.
    """
    marked = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    ids = small_or_plain(trusted.select(F.col("doc_id").alias("t_id")).where("doc_id is not null").distinct())
    marked = marked.join(ids, F.col("doc_id") == F.col("t_id"), "left").select(F.col("t_id").isNotNull().cast("bigint").alias("t"), "words", F.posexplode("words").alias("i", "w"))
    # a word's features become rows inside generated code; the last word has no pair
    following = F.get("words", F.col("i") + 1)
    pair = F.when(following.isNotNull(), bucket(2, tail(F.col("w")), tail(following)))
    marked = marked.select("t", bucket(0, F.xxhash64("w")).alias("b0"), bucket(1, head(F.col("w"))).alias("b1"), pair.alias("b2")).select("t", F.stack(F.lit(KINDS), "b0", "b1", "b2").alias("b"))
    counts = marked.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("good"))
    spine = docs.sparkSession.range(0, KINDS * BUCKETS, 1, 1).select(F.col("id").cast("int").alias("b"))
    full = spine.join(counts, "b", "left").na.fill(0, ["raw", "good"])
    rows = full.agg(F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("c"), F.sum("raw").alias("n_raw"), F.sum("good").alias("n_good"))
    share = lambda x: x["raw"] / F.col("n_raw")
    ratio = lambda x: F.log((x["good"] + F.lit(SMOOTHING) * share(x)) / (F.col("n_good") + F.lit(SMOOTHING)) / share(x))
    return rows.select(F.lit(1).alias("_tm_k"), F.transform("c", lambda x: F.when(x["raw"] == 0, F.lit(0.0)).otherwise(ratio(x))).alias("_tm_ratio"))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with base counts, ``base_failed``, ``llr`` and ``kept``.

    ``trusted`` holds the doc_ids of trusted-target documents; the raw corpus is all of ``docs``. ``llr`` is the mean
    log ratio of a text's features (hashed words, first four characters of words, pairs of neighbours' last three
    characters), 0 for a text without words (which the base rule rejects). Null texts are empty; texts of any length are
    read whole; a null doc_id is never trusted; repeated rows are judged alike, ties have equal scores; columns of
    ``docs`` with an output's name are replaced; with no trusted document every ratio is 0 and the base rules decide; an
    empty table gives no rows.
    """
    model = fit_ratio(docs, trusted)
    if trusted.limit(1).count() == 0:
        model = model.select("_tm_k", F.transform("_tm_ratio", lambda x: F.lit(0.0)).alias("_tm_ratio"))
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    rest = [c for c in docs.columns if c not in own]
    # the model is one row of a fixed size
    scored = docs.select(*rest, words_of(F.col("text")).alias("_tm_words"), F.lit(1).alias("_tm_k")).withColumn("_tm_hashes", F.transform("_tm_words", lambda w: F.xxhash64(w))).join(F.broadcast(model), "_tm_k")
    n, words, per_word = F.size("_tm_words"), F.col("_tm_words"), F.col("_tm_hashes")
    total = ratio_sum(words, per_word, lambda b: F.get(F.col("_tm_ratio"), b))
    llr = F.when(n == 0, F.lit(0.0)).otherwise(total / (KINDS * n - 1))
    base = base_columns(F.col("text"), words, per_word)
    out = scored.select(*rest, *(c.alias(k) for k, c in base.items()), llr.alias("llr"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


QUERIES = {"op7_quality_rules": query}
SQL: dict[str, str] = {}
