"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling. SQL only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import keep, let, small_or_plain, table

#: Exponents of the default targets: every document's weight is multiplied by its name's present share to the power
#: (exponent - 1), for each marginal, and the marginals of that mix are the targets. Below 1 small names gain.
TEMPERATURE = {"source": 0.85, "lang": 0.95, "topic": 0.95}
#: Largest relative error of a marginal, rounds between two looks at it, rounds after which the fitting fails.
TOLERANCE, ROUNDS, MOST_ROUNDS = 1e-12, 250, 20_000
#: Families of terms. A document's topic is the family that is strongest in it against the whole corpus.
TOPICS = {"process": ["tion", "ung"], "ongoing": ["ing", "ando"], "manner": ["ment"], "state": ["heit", "keit"], "record": ["ción", "ado"], "place": ["ou", "eur"], "being": ["sch", "er"], "origin": ["qu"]}
#: Up to so many cells one row holds them all and a single expression rakes them; beyond, every round is a job.
SMALL_CELLS = 100_000
DIMS = ("source", "lang", "topic")


def token_count(text: Column) -> Column:
    """Tokens of a text: its words (runs without \\x20 and \\x09-\\x0D)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")).cast("bigint")


def term_counts(text: Column, topics: dict[str, list[str]] = TOPICS) -> list[Column]:
    """Occurrences of each family's terms in a whole text."""
    whole = F.coalesce(text, F.lit(""))
    one = lambda term: (F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit(term), F.lit("")))) / F.lit(len(term.encode()))
    return [sum((one(t) for t in terms), F.lit(0)).cast("bigint") for terms in topics.values()]


def measured(docs: DataFrame, topics: dict[str, list[str]] | None = TOPICS, columns: list[str] | None = None) -> DataFrame:
    """All columns of ``docs`` (or ``columns``) with topic and n_tokens; texts are read once and the rows kept.

    With ``topics`` None the column ``topic`` of ``docs`` is taken as it is ("other" for null).

    A family's strength is its share in the document of all its occurrences in the corpus; ties go to the first family,
    and a text without any term has the topic "other".
    """
    rest = [c for c in columns or docs.columns if c not in ("topic", "n_tokens", "_tm_terms")]
    if topics is None:
        return keep(docs.select(*rest, F.coalesce(F.col("topic").cast("string"), F.lit("other")).alias("topic"), token_count(F.col("text")).alias("n_tokens")), "mix-rows")
    rows = keep(docs.select(*rest, token_count(F.col("text")).alias("n_tokens"), F.array(*term_counts(F.col("text"), topics)).alias("_tm_terms")), "mix-rows")
    totals = rows.agg(*(F.coalesce(F.sum(F.get("_tm_terms", F.lit(k))), F.lit(0)).alias(f"t{k}") for k in range(len(topics)))).first()
    strength = [F.get("_tm_terms", F.lit(k)) / F.lit(float(max(1, totals[k]))) for k in range(len(topics))]

    def strongest(s: Column) -> Column:
        at = F.array_position(s, F.array_max(s))
        return F.when(F.array_max(s) > 0, F.element_at(F.array(*map(F.lit, topics)), at.cast("int"))).otherwise("other")

    return rows.select(*rest, let(F.array(*strength), strongest).alias("topic"), "n_tokens")


def unit_draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by the id and the seed; null ids share one."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def with_targets(cells: DataFrame, temperature: dict[str, float], targets: dict[str, dict[str, float]]) -> DataFrame:
    """Adds ``share`` (of all tokens) and each marginal's target ``t_<name>`` to the cells, which are kept.

    The default targets are marginals of one and the same mix, so a mix that meets them all exists. Targets given by
    name are weights; a name without one keeps its default.
    """
    n = cells.agg(F.sum("tokens")).first()[0] or 0
    cur = cells.withColumn("share", F.col("tokens") / F.lit(float(max(1, n))))
    for d in DIMS:
        cur = cur.withColumn(f"m_{d}", F.sum("share").over(Window.partitionBy(d)))
    pull = reduce(lambda a, b: a * b, (F.pow(f"m_{d}", F.lit(temperature[d] - 1.0)) for d in DIMS))
    cur = keep(cur.withColumn("pulled", F.when(F.col("share") > 0, F.col("share") * pull).otherwise(0.0)), "mix-cells")
    total = cur.agg(F.sum("pulled")).first()[0] or 1.0
    for d in DIMS:
        default = F.sum("pulled").over(Window.partitionBy(d)) / F.lit(total)
        given = targets.get(d) or {}
        named = reduce(lambda c, x: F.when((F.col(d) == x[0]) & (F.col(f"m_{d}") > 0), F.lit(float(x[1]))).otherwise(c), given.items(), default)
        cur = cur.withColumn(f"t_{d}", named)
    for d in DIMS:
        if targets.get(d):  # weights of the names that have tokens sum to 1
            cur = keep(cur, "mix-cells")
            names = cur.where(F.col(f"m_{d}") > 0).groupBy(d).agg(F.first(f"t_{d}").alias("t"))
            cur = cur.withColumn(f"t_{d}", F.col(f"t_{d}") / F.lit(names.agg(F.sum("t")).first()[0] or 1.0))
    return keep(cur.select(*DIMS, "tokens", "share", *(f"t_{d}" for d in DIMS)), "mix-cells")


def rake_row(cells: DataFrame) -> DataFrame:
    """Rake in one row: the factors of all names are three arrays, and a round is an expression over the cells' groups."""
    for k, d in enumerate(DIMS):
        cells = cells.withColumn(f"i{k}", (F.dense_rank().over(Window.orderBy(d)) - 1).cast("int"))
    cells = keep(cells, "mix-indexed")
    sides = []
    for k, d in enumerate(DIMS):
        p, q = (i for i in range(3) if i != k)
        members = F.collect_list(F.struct(F.col(f"i{p}").alias("p"), F.col(f"i{q}").alias("q"), F.col("share").alias("w")))
        sides.append(cells.groupBy(F.col(f"i{k}").alias("i")).agg(F.first(f"t_{d}").alias("t"), F.sort_array(members).alias("cs")).select(F.lit(k).alias("k"), "i", "t", "cs"))
    groups = sides[0].union(sides[1]).union(sides[2]).agg(F.sort_array(F.collect_list(F.struct("k", "i", "t", "cs"))).alias("g"))
    of = lambda k: F.filter("g", lambda x: x["k"] == k)
    groups = groups.select(*(of(k).alias(f"g{k}") for k in range(3)))
    ones = [F.transform(f"g{k}", lambda _: F.lit(1.0)) for k in range(3)]
    state = keep(groups.select("g0", "g1", "g2", F.struct(*(x.alias(f"f{k}") for k, x in enumerate(ones))).alias("s")), "mix-state")

    def have(g: Column, p: Column, q: Column) -> Column:
        return F.aggregate(g["cs"], F.lit(0.0), lambda acc, c: acc + c["w"] * F.get(p, c["p"]) * F.get(q, c["q"]))

    def side(k: int, p: Column, q: Column) -> Column:
        return F.transform(f"g{k}", lambda g: let(have(g, p, q), lambda h: F.when(h > 0, g["t"] / h).otherwise(0.0)))

    def a_round(s: Column, _: Column) -> Column:
        return let(side(0, s["f1"], s["f2"]), lambda a: let(side(1, a, s["f2"]), lambda b: let(side(2, a, b), lambda c: F.struct(a.alias("f0"), b.alias("f1"), c.alias("f2")))))

    def error(k: int) -> Column:
        p, q = (F.col(f"s.f{i}") for i in range(3) if i != k)
        off = F.transform(F.arrays_zip(F.col(f"g{k}").alias("g"), F.col(f"s.f{k}").alias("f")), lambda x: F.when(x["g"]["t"] > 0, F.abs(x["f"] * have(x["g"], p, q) / x["g"]["t"] - 1)).otherwise(0.0))
        return F.coalesce(F.array_max(off), F.lit(0.0))

    done, worst = 0, 1.0
    while not worst <= TOLERANCE:  # not a number where factors have run off
        if done >= MOST_ROUNDS or worst != worst:
            raise ValueError(f"no mix meets all targets: after {done} rounds a marginal is off by {worst:.3g} of its target")
        state = keep(state.select("g0", "g1", "g2", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col("s"), a_round).alias("s")), "mix-state")
        worst, done = state.agg(F.max(F.greatest(*(error(k) for k in range(3))))).first()[0] or 0.0, done + ROUNDS
    factors = state.select(F.lit(1).alias("one"), *(F.col(f"s.f{k}").alias(f"f{k}") for k in range(3)))
    ratio = reduce(lambda a, b: a * b, (F.get(f"f{k}", F.col(f"i{k}")) for k in range(3)))
    # one row, bounded by SMALL_CELLS
    return cells.withColumn("one", F.lit(1)).join(F.broadcast(factors), "one").select(*DIMS, "tokens", F.when(F.col("share") > 0, ratio).otherwise(0.0).alias("ratio"))


def rake_table(cells: DataFrame) -> DataFrame:
    """Rake many cells: each marginal of a round is a window over its names, and the table is kept now and then."""
    cur, done, worst, step = cells.withColumn("fit", F.col("share")), 0, 1.0, 5
    while not worst <= TOLERANCE:  # not a number where factors have run off
        if done >= MOST_ROUNDS or worst != worst:
            raise ValueError(f"no mix meets all targets: after {done} rounds a marginal is off by {worst:.3g} of its target")
        for _ in range(step):
            for d in DIMS:
                have = F.sum("fit").over(Window.partitionBy(d))
                cur = cur.withColumn("have", have).withColumn("fit", F.when(F.col("have") > 0, F.col("fit") * F.col(f"t_{d}") / F.col("have")).otherwise(0.0)).drop("have")
        cur, done = keep(cur, "mix-cells"), done + step
        off = F.max(F.when(F.col("t") > 0, F.abs(F.col("h") / F.col("t") - 1)).otherwise(0.0))
        worst = max(cur.groupBy(d).agg(F.sum("fit").alias("h"), F.first(f"t_{d}").alias("t")).agg(off).first()[0] or 0.0 for d in DIMS)
    return cur.select(*DIMS, "tokens", F.when(F.col("share") > 0, F.col("fit") / F.col("share")).otherwise(0.0).alias("ratio"))


def mixed(rows: DataFrame, temperature: dict[str, float] = TEMPERATURE, targets: dict[str, dict[str, float]] | None = None, seed: int = 10) -> DataFrame:
    """Adds weight, probability and kept to rows that have source, lang, topic and n_tokens."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("(null)"))
    # one row per (source, lang, topic), so the size follows the number of names, not of documents
    cells = keep(rows.groupBy(*(name(d).alias(d) for d in DIMS)).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    few = cells.limit(SMALL_CELLS + 1).count() <= SMALL_CELLS
    ratios = keep((rake_row if few else rake_table)(with_targets(cells, temperature, targets or {})), "mix-ratios")
    top = ratios.agg(F.max("ratio")).first()[0] or 0.0
    # documents without tokens weigh nothing: they stay
    chance = F.when(F.col("tokens") > 0, F.col("ratio") / F.lit(top)).otherwise(1.0) if top > 0 else F.lit(1.0)
    fitted = ratios.select(*(F.col(d).alias(f"_tm_{d}") for d in DIMS), F.round("ratio", 6).alias("weight"), F.round(chance, 6).alias("probability"))
    on = reduce(lambda a, b: a & b, (name(d) == F.col(f"_tm_{d}") for d in DIMS))
    out = rows.join(small_or_plain(fitted, SMALL_CELLS), on, "left").drop(*(f"_tm_{d}" for d in DIMS))
    return out.withColumn("kept", unit_draw(F.col("doc_id"), seed) < F.col("probability"))


def mix_to_targets(docs: DataFrame, temperature: dict[str, float] = TEMPERATURE, targets: dict[str, dict[str, float]] | None = None, topics: dict[str, list[str]] | None = TOPICS, seed: int = 10) -> DataFrame:
    """All rows of ``docs`` with topic, n_tokens, weight, probability and ``kept``.

    Token weights are raked to the source, lang and topic marginals until none is off by more than TOLERANCE of its
    target; targets that no mix can meet raise ValueError. ``targets`` gives weights by marginal and name; the rest follow
    ``temperature``. Keeping each document with its cell's probability gives token shares that meet the three marginals
    in expectation; the largest probability is 1, so nothing is repeated. Null source or lang is a name of its own,
    "(null)"; with ``topics`` None the documents' own column topic counts; null texts have no tokens; documents of cells without any token are all kept; ties between topics go to
    the first; repeated rows share their draw; texts of any length are read whole and once; columns of ``docs`` with an
    output's name are replaced; an empty table gives no rows.
    """
    own = ["n_tokens", "weight", "probability", "kept"]
    return mixed(measured(docs.drop(*own), topics), temperature, targets, seed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = measured(table(spark, sf_dir, "documents"), columns=["doc_id", "source", "lang"])
    return mixed(rows).select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "kept")


def _sql() -> str:
    """The mix in closed form: raking converges to the one mix that has the targets and the form share x f(source) x g(lang) x h(topic)."""
    counts = [" + ".join(f"(octet_length(encode(t)) - octet_length(encode(replace(t, '{x}', '')))) // {len(x.encode())}" for x in terms) for terms in TOPICS.values()]
    strengths = [f"c{k} / greatest(sum(c{k}) OVER (), 1)::DOUBLE AS s{k}" for k in range(len(TOPICS))]
    best = f"greatest({', '.join(f's{k}' for k in range(len(TOPICS)))})"
    topic = "CASE " + " ".join(f"WHEN {best} > 0 AND s{k} = {best} THEN '{name}'" for k, name in enumerate(TOPICS)) + " ELSE 'other' END"
    pull = " * ".join(f"pow(m_{d}, {TEMPERATURE[d]} - 1)" for d in DIMS)
    out = [
        "WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)",
        "e AS (SELECT doc_id, source, lang, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens, " + ", ".join(f"({c})::BIGINT AS c{k}" for k, c in enumerate(counts)) + " FROM d)",
        f"f AS (SELECT *, {', '.join(strengths)} FROM e)",
        f"r AS (SELECT doc_id, source, lang, coalesce(source, '(null)') AS s, coalesce(lang, '(null)') AS l, {topic} AS topic, n_tokens FROM f)",
        "c AS (SELECT s AS source, l AS lang, topic, sum(n_tokens)::BIGINT AS tokens FROM r GROUP BY ALL)",
        "g AS (SELECT *, tokens / greatest(sum(tokens) OVER (), 1) AS share FROM c)",
        "h AS (SELECT *, " + ", ".join(f"sum(share) OVER (PARTITION BY {d}) AS m_{d}" for d in DIMS) + " FROM g)",
        f"i AS (SELECT *, CASE WHEN share > 0 THEN {pull} ELSE 0 END AS q FROM h)",
        "j AS (SELECT *, q / greatest(sum(q * share) OVER (), 1e-300) AS ratio, max(q) OVER () AS top FROM i)",
        "p AS (SELECT source, lang, topic, round(ratio, 6) AS weight, round(CASE WHEN tokens > 0 THEN q / top ELSE 1 END, 6) AS probability FROM j)",
    ]
    draw = "('0x' || substr(md5('10:' || coalesce(r.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0"
    return ", ".join(out) + f" SELECT r.doc_id, r.source, r.lang, r.topic, r.n_tokens, p.weight, p.probability, ({draw} < p.probability) AS kept FROM r JOIN p ON r.s = p.source AND r.l = p.lang AND r.topic = p.topic"


QUERIES = {"op10_mix_to_targets": query}
SQL = {"op10_mix_to_targets": _sql()}
