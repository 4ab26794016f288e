"""Quality rules: base counts, then robust multivariate outliers per language and source.

Four transformed statistics of a document (log mean word length, log symbols per word, log of
repeated lines and of repeated words, each plus one) form its vector. Per group of (lang, source) the minimum
covariance determinant estimate of centre and scatter is searched by concentration steps: take the h = 55 %
of rows nearest by Mahalanobis distance, compute their mean and covariance, and repeat. Four fixed
starts (shortest halves, medians, lower and upper quartiles of the coordinates) take two steps each; of every
group the two of least determinant go on until it no longer falls, and the lesser of them is the estimate, so
that up to 45 % of a group may be far off. Rows inside its 97.5 % ellipsoid give the final mean and
covariance (reweighting). A document further from its group's centre than the chi-square cutoff is rejected.

How it scales: the vectors are integers (thousandths), so sums are exact and the result does not
depend on how rows are dealt. One concentration step is one aggregation: rows are summed per
(group, start, distance bin) on the map side, at most ``DISTANCE_BINS`` rows a group and start whatever its
size, and a running sum over the bins gives the moments of the nearest h rows. A group that holds
a third of all rows is no more than its bins after the first combine. All of it is DataFrame code.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenroi.llm.common import WHITE, WHITE_CLASS, materialize, row_keys, text_or_empty, without

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Statistics in thousandths, and the least standard deviation assumed of each: what varies less
#: in a group than this is no ground for rejection. Each statistic can pass the cutoff alone: where a
#: group has no scatter beyond these, from 8 repeated lines or 127 repeated words on.
STATS = ("s_word_len", "s_symbols", "s_dup_lines", "s_repeat")
SPREAD_FLOOR = (100.0, 60.0, 450.0, 1000.0)
#: Share of a group in the h-subset, and the probabilities behind the reweighting and the cutoff.
SUBSET = 0.55
WEIGHT_P = 0.975
CUTOFF_P = 0.9999
#: Concentration steps of every start, starts of a pool that go on, and the most steps these take. They
#: end before when no determinant changes; of bins of distances instead of single rows, it may also swing.
FIRST_STEPS = 2
KEPT_STARTS = 2
STEPS = 20
#: Quantiles of a coordinate that the starts look at: 0, 1/20 .. 1.
GRID = 20
#: Smaller groups are pooled by language, then all together; a smaller pool rejects nothing.
MIN_GROUP = 50
DISTANCE_BINS = 2048


# ---- base counts -------------------------------------------------------------------------------

def _repeat_words(windows: Column) -> tuple[Column, Column, Column, Column]:
    """Expressions for the columns mask, keys, spots and the number of words inside windows (given by
    hash) that occur twice or more; each needs the ones before it as columns.

    Window hashes are sorted with their position in the low bits, so equal ones are neighbours;
    the full hashes of neighbours are compared. O(n log n) in the length of the text.
    """
    mask = F.expr("shiftleft(1L, length(bin(size(windows)))) - 1")
    keyed = F.sort_array(F.transform(windows, lambda x, i: F.coalesce(
        x.bitwiseAND(F.bitwise_not(F.col("mask"))).bitwiseOR(i.cast("long")), F.lit(0).cast("long"))))

    def twin(sorted_keys: Column, x: Column, j: Column) -> Column:
        other = F.get(sorted_keys, j)
        at = lambda key: F.get(windows, key.bitwiseAND(F.col("mask")).cast("int"))
        return F.coalesce(
            (x.bitwiseAND(F.bitwise_not(F.col("mask"))) == other.bitwiseAND(F.bitwise_not(F.col("mask"))))
            & (at(x) == at(other)), F.lit(False))

    keys = F.col("keys")
    spots = F.sort_array(F.transform(
        F.filter(keys, lambda x, i: twin(keys, x, i - 1) | twin(keys, x, i + 1)),
        lambda x: x.bitwiseAND(F.col("mask"))))
    covered = F.aggregate(
        F.col("spots"),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(
            (p + WINDOW_WORDS).alias("end"),
            (acc["n"] + p + WINDOW_WORDS - F.greatest(acc["end"], p)).alias("n")),
        lambda acc: acc["n"])
    return mask, keyed, spots, covered


def base_counts(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text_or_empty()
    trimmed = F.btrim(text, F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_CLASS + "+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    first = docs.select(*keep, words.alias("words"), lines.alias("lines"),
                        F.char_length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    names = [c for c in first.columns if c not in ("words", "lines", "n_symbols")]
    second = first.select(
        *names, "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("hashes"))
    at = lambda i, k: F.get(F.col("hashes"), i + k)
    windows = F.when(
        F.size("hashes") >= WINDOW_WORDS,
        F.transform(F.sequence(F.lit(0), F.size("hashes") - WINDOW_WORDS),
                    lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW_WORDS)]))).otherwise(F.array().cast("array<bigint>"))
    third = second.withColumn("windows", windows).drop("hashes").withColumn(
        "windows", F.when(F.size(F.array_distinct("windows")) == F.size("windows"),
                          F.array().cast("array<bigint>")).otherwise(F.col("windows")))
    mask, keys, spots, covered = _repeat_words(F.col("windows"))
    return (third.withColumn("mask", mask).withColumn("keys", keys).withColumn("spots", spots)
            .withColumn("n_repeat_words", covered).drop("windows", "mask", "keys", "spots"))


def _statistics() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log1p(F.col("n_symbols") / n),
              F.log1p("n_dup_lines"), F.log1p("n_repeat_words"))
    return [F.round(1000 * v).cast("long").alias(name) for v, name in zip(values, STATS, strict=True)]


# ---- robust estimates --------------------------------------------------------------------------

def _chi2_cdf(x: float, dof: int) -> float:
    """Of an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(dof // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def _chi2_quantile(p: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, dof) < p else (low, mid)
    return high


P = len(STATS)
CUTOFF = _chi2_quantile(CUTOFF_P, P)


def _consistency(share: float) -> float:
    """Makes the covariance of the nearest ``share`` of rows estimate that of all, under normality."""
    return share / _chi2_cdf(_chi2_quantile(share, P), P + 2)


CONSISTENCY = _consistency(SUBSET)
WEIGHT_CUT = _chi2_quantile(WEIGHT_P, P)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _factored(moments: DataFrame) -> DataFrame:
    """pool, start (if any), centre m_i, the Cholesky factor l_i_j of the scatter v_i_j plus the floor, and
    the log of its determinant."""
    out = moments
    for i, j in PAIRS:
        value = F.col(f"v_{i}_{j}") + (SPREAD_FLOOR[i] ** 2 if i == j else 0.0)
        for k in range(j):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        out = out.withColumn(f"l_{i}_{j}", F.sqrt(value) if i == j else value / F.col(f"l_{j}_{j}"))
    log_det = reduce(lambda a, b: a + b, [2 * F.log(f"l_{i}_{i}") for i in range(P)])
    return out.select(*_keys(moments), *[f"m_{i}" for i in range(P)], *[f"l_{i}_{j}" for i, j in PAIRS],
                      log_det.alias("log_det"))


def _keys(estimates: DataFrame) -> list[str]:
    return [c for c in ("pool", "start") if c in estimates.columns]


def _with_distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance ``d2``, once a start of the pool where ``estimates``
    have starts; null where the pool has no estimate."""
    out = rows.join(estimates, "pool", "left")
    for i in range(P):
        y = F.col(STATS[i]) - F.col(f"m_{i}")
        for k in range(i):
            y = y - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        out = out.withColumn(f"y_{i}", y / F.col(f"l_{i}_{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(P)])
    return out.withColumn("d2", d2).select(*rows.columns, *[c for c in _keys(estimates) if c != "pool"], "d2")


def _start(vectors: DataFrame) -> DataFrame:
    """Four centres and spreads a pool, from quantiles of the coordinates: shortest half (middle and
    length), median and quartile range, lower and upper quartile with the length of the shortest half. Values are
    thousandths, so the exact percentile keeps a count for each of a few thousand values and
    combines on the map side."""
    grid = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    marks = vectors.groupBy("pool").agg(*[
        F.percentile(F.col(s), grid, F.col("n")).alias(f"q_{i}") for i, s in enumerate(STATS)])
    at = lambda i, k: F.get(f"q_{i}", F.lit(k))
    half = GRID // 2
    halves = marks.withColumns({f"half_{i}": F.array_min(F.array(*[
        F.struct((at(i, k + half) - at(i, k)).alias("width"), ((at(i, k) + at(i, k + half)) / 2).alias("middle"))
        for k in range(GRID - half + 1)])) for i in range(P)})
    width = lambda i: F.col(f"half_{i}.width")
    centres_and_spreads = (
        (lambda i: F.col(f"half_{i}.middle"), width),
        (lambda i: at(i, half), lambda i: at(i, 3 * GRID // 4) - at(i, GRID // 4)),
        (lambda i: at(i, GRID // 4), width),
        (lambda i: at(i, 3 * GRID // 4), width))
    starts = halves.select("pool", F.posexplode(F.array(*[
        F.struct(*[centre(i).alias(f"m_{i}") for i in range(P)], *[(spread(i) / 1.349).alias(f"s_{i}") for i in range(P)])
        for centre, spread in centres_and_spreads])).alias("start", "at"))
    return starts.select(
        "pool", "start", *[F.col(f"at.m_{i}").alias(f"m_{i}") for i in range(P)],
        *[(F.col(f"at.s_{i}") * F.col(f"at.s_{i}") if i == j else F.lit(0.0)).alias(f"v_{i}_{j}") for i, j in PAIRS])


def _sums() -> list[Column]:
    """Rows, sums and sums of products of vectors that stand for ``n`` rows each."""
    n = F.col("n")
    return [F.sum("n").alias("n"), *[F.sum(F.col(s) * n).alias(f"s_{i}") for i, s in enumerate(STATS)],
            *[F.sum(F.col(STATS[i]) * F.col(STATS[j]) * n).alias(f"p_{i}_{j}") for i, j in PAIRS]]


def _moments(sums: DataFrame, consistency: float) -> DataFrame:
    n = F.col("n")
    mean = [F.col(f"s_{i}") / n for i in range(P)]
    return sums.select(
        *_keys(sums), *[mean[i].alias(f"m_{i}") for i in range(P)],
        *[((F.col(f"p_{i}_{j}") / n - mean[i] * mean[j]) * consistency).alias(f"v_{i}_{j}") for i, j in PAIRS])


def _concentrate(vectors: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: mean and covariance of the nearest h rows of every pool, for each of its starts."""
    d2 = _with_distance(vectors, estimates)
    bins = d2.withColumn("bin", F.least(F.floor(F.log1p("d2") * 64), F.lit(DISTANCE_BINS - 1)).cast("int"))
    sums = bins.groupBy("pool", "start", "bin").agg(*_sums())
    whole = Window.partitionBy("pool", "start")
    nearest = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = [c for c in sums.columns if c not in ("pool", "start", "bin")]
    running = sums.select(
        "pool", "start", F.col("n").alias("own"), F.sum("n").over(whole).alias("all"),
        *[F.sum(c).over(nearest).alias(c) for c in names])
    h = F.ceil(F.col("all") * SUBSET)
    return _moments(running.filter((F.col("n") >= h) & (F.col("n") - F.col("own") < h)), CONSISTENCY)


def _least(estimates: DataFrame, count: int) -> DataFrame:
    """The ``count`` starts of each pool with the least determinant."""
    order = Window.partitionBy("pool").orderBy("log_det", "start")
    return estimates.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count).drop("place")


def minimum_determinant(vectors: DataFrame) -> DataFrame:
    """The estimate of each pool: the least determinant that concentration from the starts finds, reweighted.

    ``vectors`` holds pool, the statistics and n, the number of rows that a vector stands for; it is read once a
    step. The driver only learns whether a determinant has changed."""
    tried = materialize(_factored(_start(vectors)), "quality-start")
    for _ in range(FIRST_STEPS):
        tried = materialize(_factored(_concentrate(vectors, tried)), "quality-step")
    tried = materialize(_least(tried, KEPT_STARTS), "quality-kept")
    for _ in range(STEPS):
        before = tried.select("pool", "start", F.col("log_det").alias("before"))
        tried = materialize(_factored(_concentrate(vectors, tried)), "quality-step")
        if tried.join(before, ["pool", "start"]).filter(F.abs(F.col("log_det") - F.col("before")) > 1e-9).isEmpty():
            break
    raw = _least(tried, 1).drop("start")
    inside = _with_distance(vectors, raw).filter(F.col("d2") <= WEIGHT_CUT).groupBy("pool").agg(*_sums())
    return materialize(_factored(_moments(inside, _consistency(WEIGHT_P))), "quality-estimates")


def _pools(groups: DataFrame) -> DataFrame:
    """(lang, source) group -> the pool whose estimate judges it, from a table of group sizes;
    groups without one are left out."""
    small = F.col("n") < MIN_GROUP
    named = groups.withColumn("pool", F.when(~small, F.to_json(F.struct("lang", "source")))
                              .otherwise(F.to_json(F.struct("lang"))))
    last = _sized(named).withColumn(
        "pool", F.when(F.col("pool_n") >= MIN_GROUP, F.col("pool")).otherwise(F.lit("*"))).drop("pool_n")
    return _sized(last).filter(F.col("pool_n") >= MIN_GROUP).select("group", "pool")


def _sized(groups: DataFrame) -> DataFrame:
    """``groups`` with the rows of their pool; sums are joined, as a window would bring a pool's groups to one task."""
    return groups.join(groups.groupBy("pool").agg(F.sum("n").alias("pool_n")), "pool")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text, lang, source): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, d2 (squared distance, null where
    nothing was estimated).

    A null or empty text has no words and fails the base rule. A null lang or source is a group of
    its own. Repeated rows count and are judged one by one, ties alike. A pool under
    ``MIN_GROUP`` rows rejects nothing beyond the base rule. An empty table gives no rows.
    """
    return _judged(docs, [F.col("doc_id")]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "d2")


def _judged(docs: DataFrame, keep: list[Column]) -> DataFrame:
    group = F.to_json(F.struct(F.col("lang"), F.col("source"))).alias("group")
    counted = base_counts(docs, [*keep, F.col("lang"), F.col("source"), group])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = materialize(counted.withColumn("base_failed", failed).select("*", *_statistics()), "quality-stats")

    passed = stats.filter("not base_failed")
    pools = materialize(_pools(passed.groupBy("group").agg(
        F.first("lang").alias("lang"), F.first("source").alias("source"), F.count("*").alias("n"))), "quality-pools")
    # equal vectors of a group are one row with a count from here on
    vectors = materialize(
        passed.groupBy("group", *STATS).agg(F.count("*").alias("n"))
        .join(pools, "group").drop("group"), "quality-vectors")
    estimates = minimum_determinant(vectors)
    judged = _with_distance(stats.join(pools, "group", "left"), estimates)
    inside = F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns: those with ``kept`` in :func:`quality_rules`.

    A verdict follows from text, lang and source, so that rows of one id and text in two sources are judged apart;
    rows that agree in all of these share it. Nulls, empty texts and small groups as there; long texts are counted
    whole; an empty table stays empty. Verdicts go to the rows by id, hash of the text and group: of rejected rows only
    these move."""
    rejected = _judged(docs, row_keys()).filter("not kept").select(
        F.col("__id").alias("__r_id"), F.col("__key").alias("__r_key"), F.col("group").alias("__r_group")).distinct()
    own = docs.withColumns({"__doc_" + name: column for name, column in zip(("id", "key"), row_keys(), strict=True)})
    own = own.withColumn("__doc_group", F.to_json(F.struct(F.col("lang"), F.col("source"))))
    return own.join(rejected, (F.col("__doc_id") == F.col("__r_id")) & (F.col("__doc_key") == F.col("__r_key"))
                    & (F.col("__doc_group") == F.col("__r_group")), "left_anti").select(*docs.columns)
