"""Temperature mixing of sources, realised as budgeted block permutations.

Shares p of the sources' tokens become weights proportional to p**t. The exponent t is bisected
until the weights meet a target entropy or until no source is repeated more often than a limit.
Weights times the token budget give each source whole passes over its documents and one part of
a pass. Every pass is a permutation by hash; the part is its longest beginning within the budget.
A source's passes are spread evenly over the blocks of the output, so each block has the weights.

How it scales: shares are one row a source. The end of the part pass is found from sums over
hash buckets (combined on the map side) and an exact running sum within the one bucket where the
budget ends, ``1 / BUCKETS`` of a source even if it holds a third of all rows. It is a threshold on
the hash, so a document's copies follow from its own row and its source's row: texts never
shuffle. Only DataFrame functions run on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, text_or_empty

MAX_REPEAT = 2.0
BYTES_A_TOKEN = 4
SEED = 17
BLOCK_TOKENS = 100_000
BUCKETS = 1 << 14
#: Bisection steps, and how many of them one job looks ahead.
STEPS, AHEAD = 30, 5
_KEY_BITS = 60


def token_count() -> Column:
    """About as many tokens as a subword tokenizer makes: a fourth of the text's UTF-8 bytes, rounded up, and one
    end mark. Blanks do not matter, so texts without any (Chinese, minified code) count by their size too."""
    return (F.ceil(F.octet_length(text_or_empty()) / F.lit(BYTES_A_TOKEN)) + 1).cast("long")


def row_name() -> Column:
    """What places a row in a permutation: its doc_id and text. Rows of one id have places of their own; rows
    that repeat id and text share one."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")),
                             F.md5(text_or_empty().cast("binary"))).cast("binary"))


def shuffle_key(epoch: Column, seed: int, name: Column) -> Column:
    """60 bits that place a row, by its :func:`row_name`, in the permutation of an epoch."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary")),
                              1, _KEY_BITS // 4), 16, 10).cast("long")


def _source() -> Column:
    return F.to_json(F.struct("source"))  # a null source is one of its own


def bisect(shares: DataFrame, high: float, too_low: Callable[[float, float, float], bool]) -> float:
    """The exponent in [0, ``high``] where ``too_low(t, z, s)`` turns false, with z = sum p**t and
    s = sum p**t * ln p. One job sums both for every exponent the next ``AHEAD`` steps can reach."""
    low = 0.0
    p = F.col("share")
    for _ in range(0, STEPS, AHEAD):
        n = 2**AHEAD
        grid = [low + (high - low) * k / n for k in range(1, n)]
        sums = shares.agg(*[F.sum(F.pow(p, F.lit(t))) for t in grid],
                          *[F.sum(F.pow(p, F.lit(t)) * F.log(p)) for t in grid]).first()
        a, b = 0, n
        while b - a > 1:
            mid = (a + b) // 2
            if too_low(grid[mid - 1], sums[mid - 1], sums[n - 1 + mid - 1]):
                a = mid
            else:
                b = mid
        low, high = low + (high - low) * a / n, low + (high - low) * b / n
    return round(high, 8)


def mixing_plan(docs: DataFrame, max_repeat: float = MAX_REPEAT, target_entropy: float | None = None,
                budget: int | None = None, seed: int = SEED) -> DataFrame:
    """One row a source: __source, tokens, weight, repeat, passes, cut (last key of the part pass,
    -1 if none). Without ``budget`` the least one is taken at which every document appears."""
    sizes = materialize(docs.select(_source().alias("__source"), row_name().alias("__row"), token_count().alias("n")), "mixing-sizes")
    tokens = materialize(sizes.groupBy("__source").agg(F.sum("n").alias("tokens")), "mixing-tokens")
    total, least, most = tokens.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if total is None:
        return tokens.select("__source", "tokens", *[F.lit(0.0).alias(c) for c in ("weight", "repeat")],
                             *[F.lit(0).cast("long").alias(c) for c in ("passes", "cut")])
    shares = tokens.withColumn("share", F.col("tokens") / F.lit(total))
    p_min, p_max = least / total, most / total

    def repeats_too_often(t: float, z: float, _: float) -> bool:
        # the smallest source is repeated most
        often = (p_max / p_min) ** (1 - t) if budget is None else p_min ** (t - 1) * budget / (z * total)
        return often > max_repeat

    if target_entropy is not None:
        most_entropy = math.log(tokens.count())
        if not 0 <= target_entropy <= most_entropy + 1e-9:
            raise ValueError(f"No weights of these sources have entropy {target_entropy}: it is between 0 and {most_entropy:.6f}")
    elif budget is not None and budget / total > max_repeat:
        raise ValueError(f"{budget} tokens repeat {total} more than {max_repeat} times, whatever the weights")
    if target_entropy is None:
        exponent = bisect(shares, 1.0, repeats_too_often)
    else:
        exponent = bisect(shares, 8.0, lambda t, z, s: math.log(z) - t * s / z > target_entropy)
    power = F.pow("share", F.lit(exponent))
    z, slope = shares.agg(F.sum(power), F.sum(power * F.log("share"))).first()
    if target_entropy is not None and abs(math.log(z) - exponent * slope / z - target_entropy) > 1e-4:
        raise ValueError(f"No exponent from 0 to 8 gives entropy {target_entropy}; {exponent} gives {math.log(z) - exponent * slope / z:.6f}")
    flat = F.pow("share", F.lit(exponent - 1))
    repeat = flat / F.lit(p_max ** (exponent - 1)) if budget is None else flat * F.lit(budget / (z * total))
    if budget is None and exponent > 1:
        repeat = flat / F.lit(p_min ** (exponent - 1))
    sources = shares.select(
        "__source", "tokens", F.round(power / F.lit(z), 9).alias("weight"), F.round(repeat, 6).alias("repeat"))
    sources = sources.withColumn("budget", F.round(F.col("repeat") * F.col("tokens")).cast("long"))
    sources = materialize(
        sources.withColumn("passes", F.floor(F.col("budget") / F.col("tokens")).cast("long"))
        .withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens")), "mixing-sources")

    keyed = sizes.join(sources.select("__source", "passes", "rest"), "__source").withColumn(
        "key", shuffle_key(F.col("passes"), seed, F.col("__row")))
    bucket = F.shiftright("key", _KEY_BITS - BUCKETS.bit_length() + 1).alias("bucket")
    sums = keyed.groupBy("__source", "rest", bucket).agg(F.sum("n").alias("n"))
    running = sums.withColumn("upto", F.sum("n").over(
        Window.partitionBy("__source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    # the bucket in which the budget ends, and what is left for it
    last = materialize(
        running.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
        .select("__source", F.col("bucket").alias("end"), (F.col("rest") - F.col("upto") + F.col("n")).alias("left")),
        "mixing-ends")
    within = keyed.join(last, "__source").filter(bucket == F.col("end")).select("__source", "key", "n", "left")
    # rows that repeat id and text share a key and come in together: summed before the window, however many
    within = within.groupBy("__source", "key", "left").agg(F.sum("n").alias("n"))
    inside = within.withColumn("upto", F.sum("n").over(Window.partitionBy("__source").orderBy("key")))
    exact = inside.filter("upto <= left").groupBy("__source").agg(F.max("key").alias("inside"))
    ends = last.join(exact, "__source", "left").select(
        "__source", F.coalesce("inside", F.col("end") * F.lit(1 << (_KEY_BITS - BUCKETS.bit_length() + 1)) - 1).alias("cut"))
    return materialize(sources.join(ends, "__source", "left").select(
        "__source", "tokens", "weight", "repeat", "passes", F.coalesce("cut", F.lit(-1)).cast("long").alias("cut")),
        "mixing-plan")


def _copies(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``docs`` with ``__epochs``: the passes a document takes part in, 0 on."""
    joined = docs.withColumn("__source", _source()).join(plan, "__source")
    part = F.when(shuffle_key(F.col("passes"), seed, F.col("__row")) <= F.col("cut"), 1).otherwise(0)
    return joined.withColumn("__epochs", F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda e: e < F.col("passes") + part))


def mix_sources(docs: DataFrame, max_repeat: float = MAX_REPEAT, target_entropy: float | None = None,
                budget: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` (reads doc_id, text, source) mixed: every row as often as its source's weight asks,
    same columns.

    A null source is one source. Rows have places by id and text; rows that repeat both come in together, so the
    budget of a part pass is missed by at most one such set. Empty and null texts have one token, long ones a
    fourth of their bytes. An empty table stays empty. Targets that no weights reach are a ``ValueError``.
    """
    plan = mixing_plan(docs, max_repeat, target_entropy, budget, seed)
    plan = plan.select("__source", F.col("passes").alias("__passes"), F.col("cut").alias("__cut"))
    joined = docs.withColumn("__source", _source()).join(plan, "__source")
    part = F.when(shuffle_key(F.col("__passes"), seed, row_name()) <= F.col("__cut"), 1).otherwise(0)
    copies = joined.withColumn("__copies", (F.col("__passes") + part).cast("int"))
    return copies.filter("__copies > 0").select(
        *[F.col(c) for c in docs.columns], F.explode(F.array_repeat(F.lit(0), F.col("__copies"))).alias("__copy")
    ).select(*docs.columns)


def mixing_order(docs: DataFrame, max_repeat: float = MAX_REPEAT, target_entropy: float | None = None,
                 budget: int | None = None, seed: int = SEED, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for every use of a document: doc_id, source, n_tokens, epoch, block, key. Reading by
    (block, key) gives the mix; a source's epochs are spread evenly over the blocks. Nulls, empty and long texts,
    repeated rows, an empty table and targets out of reach: as in :func:`mix_sources`."""
    plan = mixing_plan(docs, max_repeat, target_entropy, budget, seed)
    whole = plan.agg(F.sum(F.round(F.col("repeat") * F.col("tokens")))).first()[0] or 0
    blocks = max(1, math.ceil(whole / block_tokens))
    rows = docs.select("doc_id", "source", token_count().alias("n_tokens"), row_name().alias("__row"))
    used = _copies(rows, plan, seed).select(
        "doc_id", "source", "n_tokens", "__row", "repeat", F.explode("__epochs").alias("epoch")).withColumn(
        "key", shuffle_key(F.col("epoch"), seed, F.col("__row")))
    place = (F.col("epoch") + F.col("key") / F.lit(float(1 << _KEY_BITS))) / F.col("repeat")
    return used.select("doc_id", "source", "n_tokens", "epoch",
                       F.least(F.floor(place * blocks), F.lit(blocks - 1)).cast("long").alias("block"), "key")
