"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Each document becomes a vector of transformed statistics. Per language and source, concentration steps look
for the share ``H`` of documents whose covariance has the least determinant; documents far from that
centre by Mahalanobis distance are rejected. Built-in functions only, from the words to the verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WORD, member_bits, parted, stored, text_hash

#: The share of documents a covariance is taken over.
H = 0.75
#: Concentration steps after the start at medians and median deviations.
STEPS = 4
#: Documents (that pass the base rules) an estimate needs; smaller groups use their language's, then all.
LEAST = 100
#: Parts that each cell's rows are dealt to, so that no task gets all rows of one cell.
SALTS = 64
#: Smallest standard deviation by statistic: below it, differences mean nothing. Its square is added to the variance. The
#: roots of shares lie in 0..1, so their floors leave room for the cutoff: among documents without any, 26% of
#: duplicate lines or repeated words are too many, and 7% of symbols.
FLOORS = {"z_words": 0.5, "z_chars": 0.06, "z_symbols": 0.05, "z_lines": 0.1, "z_repeats": 0.1}
#: H over the chance of chi-square with 7 degrees to stay below the H quantile with 5 makes the covariance of
#: the central part consistent; CUTOFF is the 1 - 1e-4 quantile of chi-square with 5 degrees.
CONSISTENCY, CUTOFF = 1.4117, 25.74
Z = list(FLOORS)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """How many words stand in a 3-word window that is found twice or more, by the windows' 64-bit hashes."""
    def covered(h: Column) -> Column:
        at = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def flagged(p: Column) -> Column:
            eq = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(p, lambda x, k: eq(x, k + 1) | F.when(k > 0, eq(x, k - 1)).otherwise(False))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def total(f: Column) -> Column:
            gaps = F.transform(f, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(f, k + 1) - x, F.lit(3))))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return _let(_let(at, flagged), total)

    def count(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(count(words)).cast("long")


def statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed)`` for each row; a null text has no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    has = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    # one pass makes words and lines; the aliases below refer to them more than once, so they stay columns
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), has("lang").alias("lang"),
                       has("source").alias("source"),
                       _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
                           F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"))).alias("w"),
                       _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (
                           F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
                       F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
                       (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"))
    rows = rows.select("doc_id", "text_hash", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
                       "w.n_repeat_words")
    return rows.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vector(rows: DataFrame) -> DataFrame:
    """The transformed statistics: logarithms of sizes, roots of shares."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return rows.withColumns({
        "z_words": F.log1p("n_words"), "z_chars": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "z_symbols": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "z_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "z_repeats": F.sqrt(F.col("n_repeat_words") / n)})


def _cell(lang: Column, source: Column) -> Column:
    """A group's name; nulls are values of their own."""
    return F.to_json(F.struct(lang.alias("l"), source.alias("s")))


def _distance(rows: DataFrame) -> Column:
    """Squared Mahalanobis distance to centre ``m_*`` by the Cholesky factor ``c_i_j`` beside each row."""
    ys: list[Column] = []
    for i, z in enumerate(Z):
        y = F.col(z) - F.col(f"m_{z}")
        for j in range(i):
            y = y - F.col(f"c_{i}_{j}") * ys[j]
        ys.append(y / F.col(f"c_{i}_{i}"))
    return sum((y * y for y in ys[1:]), ys[0] * ys[0])


def _factor(groups: DataFrame) -> DataFrame:
    """Centre and Cholesky factor from ``n``, sums ``s_*`` and products ``p_i_j`` of each group; the squared
    floors added to the diagonal keep the covariance regular where a statistic hardly varies."""
    n = F.col("n")
    out = groups.withColumns({f"m_{z}": F.col(f"s_{z}") / n for z in Z})
    for i, zi in enumerate(Z):
        for j in range(i + 1):
            v = F.col(f"p_{i}_{j}") / n - F.col(f"m_{zi}") * F.col(f"m_{Z[j]}")
            if i == j:
                v = F.greatest(v, F.lit(0.0)) * CONSISTENCY + FLOORS[zi] ** 2
            else:
                v = v * CONSISTENCY
            for k in range(j):
                v = v - F.col(f"c_{i}_{k}") * F.col(f"c_{j}_{k}")
            out = out.withColumn(f"c_{i}_{j}", F.sqrt(F.greatest(v, F.lit(FLOORS[zi] ** 2 * 1e-6))) if i == j else v / F.col(f"c_{j}_{j}"))
    return out.select("cell", *[f"m_{z}" for z in Z], *[f"c_{i}_{j}" for i in range(len(Z)) for j in range(i + 1)])


def estimates(spark: SparkSession, members: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of each ``cell`` of ``members(cell, salt, z_*)``, by concentration steps. Each step
    is one aggregate for the radius and one for the sums; only one row a cell is kept between steps, in the shared
    folder. A cell's rows meet its estimate in ``SALTS`` parts, which are aggregated apart before the parts meet."""
    quantile = lambda c, p: F.percentile_approx(c, p, 10000)

    def beside(rows: DataFrame, cells: DataFrame) -> DataFrame:
        """Each row with the columns of its cell; the cells, not the rows, are repeated."""
        return rows.join(cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["cell", "salt"])

    middle = stored(spark, members.groupBy("cell").agg(*[quantile(z, 0.5).alias(f"m_{z}") for z in Z]), "mcd-medians")
    spread = beside(members, middle).groupBy("cell").agg(
        *[F.first(f"m_{z}").alias(f"m_{z}") for z in Z],
        *[F.greatest(quantile(F.abs(F.col(z) - F.col(f"m_{z}")), 0.5) * 1.4826, F.lit(FLOORS[z])).alias(f"c_{i}_{i}") for i, z in enumerate(Z)])
    now = spread.withColumns({f"c_{i}_{j}": F.lit(0.0) for i in range(len(Z)) for j in range(i)})
    for step in range(STEPS):
        now = stored(spark, now, f"mcd-{step}")
        far = beside(members, now).select("cell", "salt", *Z, _distance(members).alias("far"))
        radius = far.groupBy("cell").agg(quantile("far", H).alias("radius"))
        near = beside(far, radius).filter("far <= radius")
        now = _factor(near.groupBy("cell").agg(
            F.count("*").alias("n"), *[F.sum(z).alias(f"s_{z}") for z in Z],
            *[F.sum(F.col(Z[i]) * F.col(Z[j])).alias(f"p_{i}_{j}") for i in range(len(Z)) for j in range(i + 1)]))
    return stored(spark, now, "mcd")


def verdicts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of :func:`statistics` with ``distance`` and ``kept`` for each row of ``docs(doc_id, text,
    lang, source)``.

    Rows that fail the base rules are not kept and enter no estimate. Null languages and sources (or columns
    that are missing) are groups of their own. Groups under ``LEAST`` members are judged by their language's
    estimate, then by that of all; where even that is too small (an empty or tiny table) only the base rules
    hold and ``distance`` is null. Repeated rows are judged alike."""
    rows = stored(spark, statistics(docs), "statistics")
    sound = _vector(rows.filter(~F.col("base_failed")))
    none = F.lit(None).cast("string")
    levels = [_cell(F.col("lang"), F.col("source")), F.concat(F.lit("lang "), _cell(F.col("lang"), none)), F.lit("all")]
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    members = sound.select(salt.alias("salt"), *Z, *[c.alias(f"cell_{i}") for i, c in enumerate(levels)]).select(
        F.explode(F.array(*[f"cell_{i}" for i in range(len(levels))])).alias("cell"), "salt", *Z)
    sizes = stored(spark, members.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST).select("cell"), "mcd-cells")
    every = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = estimates(spark, stored(spark, members.join(every, ["cell", "salt"], "left_semi"), "mcd-members"))
    judged = _vector(rows).withColumns({f"cell_{i}": c for i, c in enumerate(levels[:2])})
    for i in range(2):
        own = sizes.select(F.col("cell").alias(f"has_{i}"))
        judged = judged.join(own, judged[f"cell_{i}"] == own[f"has_{i}"], "left")
    last = none if sizes.filter("cell = 'all'").isEmpty() else levels[2]
    judged = judged.withColumn("cell", F.coalesce("has_0", "has_1", last))
    judged = judged.join(found, "cell", "left").withColumn("distance", _distance(judged))
    return judged.select(*rows.columns, "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))).alias("kept"))


def passing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. Only rows that may be among the rejected ones
    are joined with them."""
    bad = (verdicts(spark, docs).filter(~F.col("kept")).select("doc_id", "text_hash", "lang", "source").distinct())
    bad = stored(spark, bad.toDF("_q_id", "_q_hash", "_q_lang", "_q_source"), "rejected")
    bits = member_bits(spark, bad.select(F.xxhash64("_q_id", "_q_hash").alias("ref")))
    may, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long"), text_hash()), bits)
    on = may["doc_id"].cast("long").eqNullSafe(bad["_q_id"]) & (F.xxhash64(may["text"]) == bad["_q_hash"])
    for c in ("lang", "source"):
        if c in docs.columns:
            on = on & may[c].cast("string").eqNullSafe(bad[f"_q_{c}"])
    return may.join(bad, on, "left_anti").unionByName(rest)
