"""URL filters: path rules by longest match, then gradient-boosted trees on lexical features. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import keep, let, small_or_plain, table

#: (host, path, verdict); a rule holds for its host and all subdomains.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Trees, their depth, the most labelled urls that they are fitted on, and parts of the urls for their suffix statistics.
TREES, DEPTH, MOST_LABELLED, FOLDS = 12, 3, 20_000, 4
FEATURES = ["url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "entropy", "n_params", "param_length", "has_fragment", "n_hyphens", "suffix_share", "suffix_allow"]


def split_url(url: Column) -> dict[str, Column]:
    """Host (after the first ://, A-Z lower-cased) and path (up to ?, # or the end); both empty without ://."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.substring(u, at + 3, F.length(u))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return {"host": F.when(at > 0, host).otherwise(""), "path": F.when(at > 0, path).otherwise("")}


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> dict[str, Column]:
    """The fitting rule with the longest text (equal lengths: the smaller text) and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=False)
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    by_length: dict[int, list[tuple[str, str, str]]] = {}
    for r in ordered:
        by_length.setdefault(len(r[0] + r[1]), []).append(r)
    for n in sorted(by_length):
        for h, p, v in reversed(by_length[n]):
            fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
            name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return {"rule": name, "rule_verdict": verdict}


def _entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters in bits."""

    def bits(t: Column) -> Column:
        n = F.length(t).cast("double")
        share = F.transform(F.array_distinct(F.split(t, "")), lambda c: (F.length(t) - F.length(F.replace(t, c, F.lit("")))) / n)
        return F.aggregate(share, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))

    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(let(text, bits))


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    params = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    count = lambda t, ch: F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))
    out = {
        "url_length": F.length(u),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": count(path, "/"),
        "host_labels": count(host, ".") + 1,
        "digit_ratio": F.length(F.regexp_replace(u, "[^0-9]", "")) / F.greatest(F.length(u), F.lit(1)),
        "entropy": _entropy(u),
        "n_params": F.when(params == "", 0).otherwise(count(params, "&") + 1),
        "param_length": F.length(params),
        "has_fragment": F.instr(u, "#") > 0,
        "n_hyphens": count(host, "-") + count(path, "-"),
    }
    return {k: v.cast("double") for k, v in out.items()}


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def url_features(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    rest = [c for c in pages.columns if c not in {"host", "path", "rule", "rule_verdict", "verdict", "suffix", "allow_score", *FEATURES}]
    parts = pages.select(*rest, *(c.alias(k) for k, c in split_url(F.col("url")).items()))
    ruled = parts.select("*", *(c.alias(k) for k, c in rule_columns(F.col("host"), F.col("path"), rules).items()))
    return ruled.select("*", *(c.alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path")).items()), suffix_of(F.col("host")).alias("suffix"))


def with_suffix_statistics(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Each suffix's share of all urls and of allow among its labelled ones; others get 0 and one half."""
    found = rows.join(small_or_plain(stats, 100_000), F.col("suffix") == F.col("_tm_suffix"), "left")
    return found.withColumn("suffix_share", F.coalesce("_tm_share", F.lit(0.0))).withColumn("suffix_allow", F.coalesce("_tm_allow", F.lit(0.5))).drop("_tm_suffix", "_tm_share", "_tm_allow")


def fit(rows: DataFrame) -> tuple[DataFrame, GBTClassificationModel | None, float]:
    """Statistics of every suffix over all urls, the trees, and the verdict without trees.

    Labelled urls are those that a rule decides. The trees are fitted on the MOST_LABELLED of them that come first by
    the MD5 of the url; there a suffix's share of allow comes from the other FOLDS of the urls only, so that no url's
    label is in its own features. With a single class there is nothing to fit: its label stands (1, allow, without any
    labels).
    """
    good, fold = (F.col("rule_verdict") == "allow").cast("double"), F.pmod(F.xxhash64("url"), F.lit(FOLDS)).alias("_tm_fold")
    total = rows.agg(F.count("*")).first()[0] or 1
    parts = rows.groupBy(F.col("suffix").alias("_tm_suffix"), fold).agg(F.count("*").alias("n"), F.coalesce(F.sum(good), F.lit(0.0)).alias("_tm_good"), F.count(good).alias("_tm_labelled"))
    parts = keep(parts, "url-suffix-folds")
    allow = lambda g, n: (g + 1) / (n + 2)
    sums = parts.groupBy("_tm_suffix").agg(F.sum("n").alias("n"), F.sum("_tm_good").alias("g"), F.sum("_tm_labelled").alias("l"))
    stats = keep(sums.select("_tm_suffix", (F.col("n") / F.lit(total)).alias("_tm_share"), allow(F.col("g"), F.col("l")).alias("_tm_allow")), "url-suffixes")
    others = parts.select("_tm_suffix", "_tm_fold", F.col("_tm_good").alias("own_g"), F.col("_tm_labelled").alias("own_l")).join(sums, "_tm_suffix")
    others = keep(others.select("_tm_suffix", "_tm_fold", (F.col("n") / F.lit(total)).alias("_tm_share"), allow(F.col("g") - F.col("own_g"), F.col("l") - F.col("own_l")).alias("_tm_allow")), "url-other-folds")
    labelled = rows.where("rule_verdict is not null").withColumn("_at_fold", fold)
    labelled = labelled.join(small_or_plain(others, 100_000), (F.col("suffix") == F.col("_tm_suffix")) & (F.col("_at_fold") == F.col("_tm_fold")))
    labelled = labelled.withColumnsRenamed({"_tm_share": "suffix_share", "_tm_allow": "suffix_allow"})
    sample = labelled.select(*FEATURES, (F.col("rule_verdict") == "allow").cast("double").alias("target"), F.md5(F.col("url").cast("binary")).alias("h"))
    sample = keep(sample.orderBy("h", *FEATURES).limit(MOST_LABELLED).drop("h"), "url-sample")
    classes = [r["target"] for r in sample.select("target").distinct().collect()]
    if len(classes) < 2:
        return stats, None, classes[0] if classes else 1.0
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.coalesce(2))
    model = GBTClassifier(featuresCol="features", labelCol="target", maxIter=TREES, maxDepth=DEPTH, maxBins=64, stepSize=0.3, seed=9).fit(vectors)
    return stats, model, 1.0


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict.

    Where a rule fits it decides; else the trees do. Null urls and those without :// have an empty host and path and
    no rule, and the trees judge their features like any other's; an empty path fits no rule that ends in a slash. Urls
    of any length are read whole; of rules that fit with texts of equal length the smaller text wins. Repeated rows are
    judged alike; columns of ``pages`` with an output's name are replaced and those with a feature's name dropped; an
    empty table gives no rows.
    """
    narrow = url_features(pages.select("url"), rules)
    stats, model, constant = fit(narrow)
    rows = with_suffix_statistics(url_features(pages, rules), stats)
    keep_cols = [c for c in rows.columns if c not in {*FEATURES, "suffix", "rule_verdict"}]
    if model is None:
        judged = rows.withColumn("prediction", F.lit(constant))
    else:
        taken = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in rows.columns]
        judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.drop(*taken)))
        keep_cols = [c for c in keep_cols if c not in taken]
    own = F.when(F.col("prediction") == 1.0, "allow").otherwise("block")
    return judged.select(*keep_cols, F.coalesce("rule_verdict", own).alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op9_url_filter": query}
SQL: dict[str, str] = {}
