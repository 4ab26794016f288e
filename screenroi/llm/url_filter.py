"""URL verdicts: rules of host and path, else logistic regression on hashed character n-grams.

A URL's host and path each give the byte n-grams of ``GRAMS`` lengths of ``^host$`` and ``^path$``, hashed
to ``BUCKETS`` features of their own; a feature is on or off. The regression is fitted on a small table of
labelled URLs: at most ``TRAIN_URLS`` distinct URLs come to the driver, where Nesterov's gradient steps run
over all of them. Its weights, one number a bucket, go to all tasks; scoring is one pass over the URLs
without a shuffle.

Rules are a short list, tested as Column expressions on each row: a rule fits its host and all subdomains
of it if the path starts with the rule's path. The longest that fits decides.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, ship_package
from screenroi.llm.tokens import utf8_bytes

BLOCK, ALLOW = "block", "allow"
GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
TRAIN_URLS = 20_000
EPOCHS, DECAY = 200, 1e-4
#: Weight of the hand-labelled hosts together, as a multiple of that of the URLs judged by rules.
SEED_SHARE = 3
_SLICE_BYTES = 4 << 20

# ---- fixed values: a few hosts labelled by hand, 1 to block ----------------------------------------
SEED_LABELS = (
    ("casino-royal.example/en/1", 1), ("online-casino.example/bonus", 1), ("win-big-slots.example/en/2", 1),
    ("cheap-meds.example/en/3", 1), ("pills-online.example/buy", 1), ("cheap-viagra.example/en/4", 1),
    ("spam-links.example/en/5", 1), ("link-farm.example/fr/6", 1), ("adult-cams.example/en/7", 1),
    ("xxx-adult.example/de/8", 1), ("free-porn.example/en/9", 1), ("sports-bets.example/en/10", 1),
    ("bets-free.example/es/11", 1), ("ads-server.example/en/12", 1), ("click-track.example/t/13", 1),
    ("ad-tracker.example/en/14", 1), ("free-loans.example/en/15", 1), ("payday-cash.example/en/16", 1),
    ("city-library.example/en/1", 0), ("blog.gardening.example/en/2", 0), ("www.university.example/de/3", 0),
    ("m.newspaper.example/fr/4", 0), ("weather-report.example/en/5", 0), ("docs.software.example/en/6", 0),
    ("museum-guide.example/es/7", 0), ("recipes.kitchen.example/en/8", 0), ("forum.cycling.example/de/9", 0),
    ("history-notes.example/en/10", 0), ("www.hospital.example/fr/11", 0), ("school-district.example/en/12", 0),
    ("science-daily.example/en/13", 0), ("travel.mountains.example/es/14", 0), ("music-lessons.example/en/15", 0),
    ("open-data.example/en/16", 0), ("blog.painter.example/fr/17", 0), ("town-council.example/en/18", 0),
)


# ---- parts and rules -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rules(rules: Sequence[tuple[str, str]]) -> list[Rule]:
    """(verdict, ``host/path``) pairs, longest first; of equally long ones the longer host, then as given."""
    found = [Rule(verdict, *(part if k == 0 else "/" + part for k, part in enumerate(text.split("/", 1))))
             for verdict, text in rules]
    return sorted(found, key=lambda r: (-len(r.text), -len(r.host)))


#: The rules of the registered query.
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to
    ``?``, ``#`` or the end. Both empty for a null URL or one without ``://``."""
    text = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> DataFrame:
    """``pages`` and ``rule``, ``rule_verdict`` of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(parse_rules(rules)):
        fits = ((F.col(host) == r.host) | F.col(host).endswith("." + r.host)) & F.col(path).startswith(r.path)
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": text, "rule_verdict": verdict})


# ---- features ----------------------------------------------------------------------------------------

def _grams(texts: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the byte n-grams of ``^text$``, repeats included."""
    data, offsets = utf8_bytes(texts)
    rows = len(offsets) - 1
    sizes = np.diff(offsets)
    # every text between two marks
    ends = offsets[1:] + 2 * np.arange(1, rows + 1)
    marked = np.zeros(len(data) + 2 * rows, np.uint64)
    inner = np.ones(len(marked), bool)
    inner[ends - 1] = False
    inner[ends - sizes - 2] = False
    marked[inner] = data
    marked[ends - sizes - 2], marked[ends - 1] = 256, 257
    owner = np.repeat(np.arange(rows), sizes + 2)
    at, found = [], []
    for n in GRAMS:
        if len(marked) < n:
            continue
        key = np.full(len(marked) - n + 1, seed * 31 + n, np.uint64)
        for k in range(n):
            key = (key ^ marked[k:len(marked) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        own = owner[:len(key)] == owner[n - 1:]
        at.append(owner[:len(key)][own])
        found.append((key[own] % np.uint64(BUCKETS)).astype(np.int64))
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(at), np.concatenate(found)


def features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) pairs, each once, in order."""
    parts = [_grams(host, 1), _grams(path, 2)]
    row, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
    code = np.unique(row * BUCKETS + bucket)
    return code // BUCKETS, code % BUCKETS


@dataclass
class Regression:
    """z = bias + sum of the weights of a URL's features over the root of their number."""

    weights: np.ndarray
    bias: float

    def margins(self, rows: int, row: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(1, np.bincount(row, minlength=rows)))
        return self.bias + np.bincount(row, self.weights[bucket], rows) / size

    def scores(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(len(host), *features(host, path)), -50, 50)))


def fit_regression(row: np.ndarray, bucket: np.ndarray, labels: np.ndarray, weight: np.ndarray,
                   epochs: int = EPOCHS, decay: float = DECAY) -> Regression:
    """Weighted logistic loss with a squared penalty, Nesterov steps from zero; no chance in it."""
    rows = len(labels)
    total = weight.sum()
    share = float((weight * labels).sum() / total) if total > 0 else 0.0
    if not 0 < share < 1:  # no label or one kind only: that verdict for all
        return Regression(np.zeros(BUCKETS), -50.0 if share == 0 else 50.0)
    value = (1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=rows))))[row]
    known, column = np.unique(bucket, return_inverse=True)
    w = ahead = np.zeros(len(known) + 1)
    # rows have unit length, so that the loss's curvature is at most (1 + 1) / 4
    step = 1 / (0.5 + decay)
    for k in range(epochs):
        z = ahead[-1] + np.bincount(row, ahead[column] * value, rows)
        slack = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) / total
        slope = np.append(np.bincount(column, slack[row] * value, len(known)), slack.sum())
        slope[:-1] += decay * ahead[:-1]
        last, w = w, ahead - step * slope
        ahead = w + k / (k + 3) * (w - last)
    weights = np.zeros(BUCKETS)
    weights[known] = w[:-1]
    return Regression(weights, float(w[-1]))


# ---- learning and verdicts -------------------------------------------------------------------------

def train(labelled: DataFrame, most: int = TRAIN_URLS) -> Regression:
    """From rows of (url, blocked 0 or 1, weight). A URL counts once, blocked if one of its rows says so, with its
    largest weight; of more than ``most`` URLs those of least hash are taken. Null labels do not count."""
    host, path = url_parts(F.col("url"))
    rows = labelled.filter(F.col("blocked").isNotNull() & F.col("url").isNotNull())
    rows = rows.groupBy("url").agg(F.max(F.col("blocked").cast("int")).alias("blocked"), F.max(F.col("weight").cast("double")).alias("weight"))
    rows = rows.orderBy(F.xxhash64("url"), "url").limit(most)  # bounded: `most` short rows
    sample = rows.select("url", host.alias("host"), path.alias("path"), "blocked", "weight").toArrow().sort_by("url")
    parts = [sample[c].combine_chunks() if sample.num_rows else pa.array([], pa.string()) for c in ("host", "path")]
    row, bucket = features(*parts)
    return fit_regression(row, bucket, np.asarray(sample["blocked"], dtype=float), np.asarray(sample["weight"], dtype=float))


def rule_labels(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, most: int = TRAIN_URLS) -> DataFrame:
    """(url, blocked, weight): URLs that a rule judges, ``most`` by hash, and the seed list, whose weight
    is ``SEED_SHARE`` times theirs."""
    host, path = url_parts(F.col("url"))
    judged = with_rule(pages.select("url", host.alias("host"), path.alias("path")), rules).filter(F.col("rule").isNotNull())
    judged = judged.groupBy("url").agg(F.max((F.col("rule_verdict") == BLOCK).cast("int")).alias("blocked"))
    judged = materialize(judged.orderBy(F.xxhash64("url"), "url").limit(most - len(SEED_LABELS)), "url-labels")
    share = SEED_SHARE * max(1, judged.count()) / len(SEED_LABELS)
    seeds = pages.sparkSession.createDataFrame([("http://" + u, b, share) for u, b in SEED_LABELS], "url string, blocked int, weight double")
    return judged.withColumn("weight", F.lit(1.0)).unionByName(seeds)


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_ = max(1, batch.column("host").nbytes + batch.column("path").nbytes)
            step = max(1, batch.num_rows * _SLICE_BYTES // max(bytes_, _SLICE_BYTES))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                score = model.value.scores(part.column("host"), part.column("path"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    return run


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
                 most: int = TRAIN_URLS) -> DataFrame:
    """One row per row of ``pages`` (reads page_id, url): page_id, host, path, rule, verdict, score.

    ``score`` is the regression's probability of block, ``verdict`` the rule's, else block from a score of one
    half on. A null URL, or one without ``://``, has an empty host and path, no rule, and the score of no
    n-grams but the marks'. Repeated rows have the same verdicts; very long URLs are read whole; an empty table gives
    no rows. Without labels of both kinds the only kind there is, or allow, is every score's verdict.
    """
    spark = pages.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(train(labelled, most))
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    kind = rows.schema["page_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(model), f"page_id {kind}, host string, path string, score double")
    judged = with_rule(scored, rules)
    own = F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")
