"""Personal data by weak supervision, as DataFrame expressions.

Base spans (email, ip, card, phone) come from fixed patterns. Further candidates are runs of
letters, digits and ``+/_-`` with a digit among them, account numbers in groups of four, and whatever is assigned to
a private name (``password: ...``). Five labelers vote on each (private, not
private, or no opinion): shapes of keys and numbers (regex), lists that the span itself is looked up in (gazetteer:
account countries with their lengths, beginnings of known keys, words that stand in for values), names before the
span and assignment and path signs around it (context), and the mix of its characters. Expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is; its
posteriors train the final span classifier, a naive Bayes over features of the span. Accepted
candidates are added to the base spans.

One pass over the texts writes spans and candidates, a few numbers a row; nothing else reads
texts and no text shuffles. What the driver sees are counts of vote patterns (243 at most) and of
feature values, aggregated over all candidates.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenroi.llm.common import materialize, text_or_empty

# ---- patterns ----------------------------------------------------------------------------------
# Written so that each scan is linear: possessive, and starting only where a run starts. A run that
# does not match from its start does not match from its inside; \G lets a match start right
# behind the one before.

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # longest chains of digits with single separators, of 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{8,}+"
_GROUPED = r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+"
# the short look behind comes first: the one for names is tried behind an assignment sign only
_ASSIGNED = (r"(?<=[=:]\s{0,2}[\"']?)(?<=(?i:password|passwd|passwort|kennwort|passe|contraseña|pwd|secret|token|api.?key)"
             r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?)(?:[^\s\"',;.<>]|\.(?=[^\s\"',;.<>])){4,}+")
CANDIDATE = rf"(?<![A-Za-z0-9]){_GROUPED}(?![A-Za-z0-9])|{_RUN}|{_ASSIGNED}"
KINDS = list(PATTERNS)
ADDED = "secret"

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ONLY_DIGITS = "[^0-9]"

# ---- labelers' lists ---------------------------------------------------------------------------
KEY_SHAPES = (r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[a-z]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9_-]{16,}"
              r"|[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9-]{13,23}"
              rf"|{_GROUPED})$")
PLAIN_SHAPES = (r"^(?:[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}|[0-9]{1,12}"
                r"|[A-Za-z]{3,}[-_]?[0-9]{1,4}|[0-9]{1,4}[-_]?[A-Za-z]{3,}|[vV]?[0-9]+(?:[-_][0-9]+)*)$")
PRIVATE_NAMES = (r"(?i)(?:password|passwd|passwort|contrase|pwd|token|secret|api.?key|access.?key|key|auth|bearer"
                 r"|credential|ssn|iban|passport|account|konto|compte|cuenta)[^A-Za-z0-9]{1,6}$")
PUBLIC_NAMES = (r"(?i)(?:version|licen[cs]e|copyright|page|chapter|figure|table|section|volume|isbn|issn|doi|rfc|iso"
                r"|https?|www)[^A-Za-z0-9]{0,6}$")
# Gazetteer; fixed values: lengths of account numbers by country, beginnings of issued keys, and words that
# follow a private name without being its value.
ACCOUNT_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
    "SK": 24, "TR": 26}
KEY_BEGINNINGS = ("AKIA", "ASIA", "AIza", "eyJ", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_",
                  "pk_live_", "xoxb-", "xoxp-", "npm_", "pypi-")
STAND_INS = ("your", "the", "this", "that", "none", "null", "true", "false", "required", "optional", "string", "value",
             "example", "unknown", "invalid", "expired", "forgotten", "missing", "empty", "default", "undefined",
             "hidden", "redacted", "removed", "here", "must", "please", "enter", "what", "when", "with", "votre",
             "ihre", "dein", "bitte", "requis", "requerido", "xxxx", "****", "********")


def _fold(items: Column, empty: Column, add) -> Column:
    """All that a left fold puts out: ``add(at, out, item)`` gives the next ``at`` (an int, 0 first) and
    ``out`` with the item's output appended. Appending copies an array, so the fold runs over blocks
    of about the square root of the items and puts the blocks' outputs together at the end."""
    def step(acc: Column, item: Column) -> Column:
        at, out = add(acc["at"], acc["out"], item)
        return F.struct(at.alias("at"), out.alias("out"))

    def blocks(every: Column) -> Column:
        side = F.greatest(F.ceil(F.sqrt(F.size(every))).cast("int"), F.lit(1))
        last = F.greatest(F.floor((F.size(every) - 1) / side).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(every, b * side + 1, side))

    first = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    done = F.aggregate(
        F.get(F.transform(F.array(items), blocks), F.lit(0)),  # the items are made once
        F.array(first),
        lambda acc, block: F.concat(acc, F.array(F.aggregate(
            block, F.struct(F.element_at(acc, -1)["at"].alias("at"), empty.alias("out")), step))))
    return F.flatten(F.transform(done, lambda block: block["out"]))


def spans_of(text: Column, pattern: str, context: bool = False) -> Column:
    """array<struct<start,end,match[,left,right]>> of the leftmost non-overlapping matches, in code
    points: the pieces between matches and the matches, in turn, measure the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    fields = "start:int,end:int,match:string" + (",left:string,right:string" if context else "")
    empty = F.array().cast(f"array<struct<{fields}>>")
    rows = F.get(F.transform(F.array(F.split(text, pattern, -1)), lambda pieces: F.arrays_zip(
        found.alias("match"), pieces.alias("piece"),
        F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))).alias("next"))), F.lit(0))

    def add(at: Column, spans: Column, row: Column) -> tuple[Column, Column]:
        start = at + F.char_length(row["piece"])
        end = start + F.char_length(row["match"])
        own = [start.alias("start"), end.alias("end"), row["match"].alias("match")]
        if context:
            own += [F.right(row["piece"], F.lit(24)).alias("left"), F.substring(row["next"], 1, 2).alias("right")]
        # the last piece has no match behind it
        more = F.when(row["match"].isNull(), empty).otherwise(F.array(F.struct(*own)))
        return F.coalesce(end, start), F.concat(spans, more)

    return F.when(text.rlike(pattern), _fold(rows, empty, add)).otherwise(empty)


def apart(runs: Column, base: Column) -> Column:
    """The ``runs`` that overlap no span of ``base``, in order of their ends: both are sorted together,
    a base span by its start and a run by its end, and the farthest end of the base spans so far is
    compared with the run's start."""
    fields = "start:int,end:int,match:string,left:string,right:string"
    empty = F.array().cast(f"array<struct<{fields}>>")
    nothing = F.lit(None).cast("string")

    def event(s: Column, place: str, is_base: bool) -> Column:
        rest = [(nothing if is_base else s[c]).alias(c) for c in ("match", "left", "right")]
        return F.struct(s[place].alias("place"), F.lit(is_base).alias("is_base"), s["start"].alias("start"),
                        s["end"].alias("end"), *rest)

    both = F.sort_array(F.concat(F.transform(runs, lambda r: event(r, "end", False)),
                                 F.transform(base, lambda b: event(b, "start", True))))

    def add(top: Column, out: Column, s: Column) -> tuple[Column, Column]:
        run = F.struct(*[s[c].alias(c) for c in ("start", "end", "match", "left", "right")])
        return (F.when(s["is_base"], F.greatest(top, s["end"])).otherwise(top),
                F.when(s["is_base"] | (top > s["start"]), out).otherwise(F.concat(out, F.array(run))))

    return F.when((F.size(runs) == 0) | (F.size(base) == 0), runs).otherwise(_fold(both, empty, add))


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, _ONLY_DIGITS, "")
    if kind == "ip":
        return match.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _distinct_chars(x: Column) -> Column:
    return F.size(F.array_distinct(F.split(x, "")))


def _fits_account(match: Column) -> Column:
    """An account number, grouped or not, of a listed country and of its length."""
    lengths = F.create_map(*[F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair])
    compact = F.replace(match, F.lit(" "), F.lit(""))
    return compact.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]+$") & F.coalesce(
        F.try_element_at(lengths, F.left(compact, F.lit(2))) == F.char_length(compact), F.lit(False))


#: Votes in {-1, 0, 1}; the candidate is a struct of start, end, match, left, right.
def _votes(c: Column) -> dict[str, Column]:
    match, left = c["match"], c["left"]
    turns = F.length(F.regexp_replace(F.regexp_replace(match, "[0-9]+", "0"), "[^0]+", "a"))
    return {
        "shape": F.when(match.rlike(KEY_SHAPES), 1).when(match.rlike(PLAIN_SHAPES), -1).otherwise(0),
        "name": F.when(left.rlike(PRIVATE_NAMES), 1).when(left.rlike(PUBLIC_NAMES), -1).otherwise(0),
        "list": F.when(_fits_account(match) | reduce(lambda a, b: a | b, [match.startswith(k) for k in KEY_BEGINNINGS]), 1)
                 .when(F.lower(match).isin(*STAND_INS) | match.rlike(f"^{_GROUPED}$"), -1).otherwise(0),
        "place": F.when(left.rlike("[A-Za-z_]\\s*[=:]\\s*[\"']?$"), 1)
                  .when(left.rlike("(?:[/.#@&?]|://\\S*)$"), -1).otherwise(0),
        "mix": F.when((turns >= 5) & (_distinct_chars(match) >= 8), 1).when(turns <= 2, -1).otherwise(0),
    }


LABELERS = ("shape", "list", "name", "place", "mix")


#: Features of the final classifier, each a small integer.
def _features(c: Column) -> dict[str, Column]:
    match = c["match"]
    n = F.char_length(match)
    share = lambda cls: F.floor(4 * F.char_length(F.regexp_replace(match, f"[^{cls}]", "")) / n)
    return {
        "length": F.least(F.floor(n / 4), F.lit(10)),
        "digits": share("0-9"), "upper": share("A-Z"), "lower": share("a-z"),
        "hex": F.when(match.rlike("^[0-9a-f]+$"), 2).when(match.rlike("^[0-9A-F]+$"), 1).otherwise(0),
        "before": F.when(c["left"].rlike("[=:\"']\\s*$"), 2).when(c["left"].rlike("\\s$"), 1).otherwise(0),
        "named": F.when(c["left"].rlike(PRIVATE_NAMES), 1).otherwise(0),
        "listed": F.when(_fits_account(match), 1).when(F.lower(match).isin(*STAND_INS), -1).otherwise(0),
        "distinct": F.least(F.floor(_distinct_chars(match) / 3), F.lit(6)),
    }


FEATURES = ("length", "digits", "upper", "lower", "hex", "before", "named", "listed", "distinct")


def find(docs: DataFrame) -> DataFrame:
    """Per row, written once: doc_id, a column of base spans per kind, and ``candidates`` with
    votes and features in place of their text."""
    out = docs.select("doc_id", text_or_empty().alias("__text"))
    for kind, pattern in PATTERNS.items():
        out = out.withColumn(f"__{kind}", F.filter(
            spans_of(F.col("__text"), pattern), lambda s: _valid(kind, s["match"])))  # noqa: B023
        out = out.withColumn(f"__{kind}", F.transform(f"__{kind}", lambda s: F.struct(s["start"], s["end"])))
    out = out.withColumn("__base", F.concat(*[F.col(f"__{k}") for k in KINDS]))
    out = out.withColumn("__every", spans_of(F.col("__text"), CANDIDATE, context=True))
    out = out.withColumn("__runs", apart(F.col("__every"), F.col("__base")))
    candidates = F.transform("__runs", lambda c: F.struct(
        c["start"], c["end"],
        *[v.cast("int").alias(f"v_{k}") for k, v in _votes(c).items()],
        *[v.cast("int").alias(f"f_{k}") for k, v in _features(c).items()]))
    return materialize(out.select("doc_id", *[f"__{k}" for k in KINDS], candidates.alias("candidates")), "pii-found")


# ---- reliabilities -----------------------------------------------------------------------------

#: Prior belief in a labeler: (private, not) chance of each vote, and how many votes it weighs.
_PRIOR = {1: (0.5, 0.1), 0: (0.35, 0.35), -1: (0.15, 0.55)}
_PRIOR_WEIGHT, _PRIOR_PRIVATE, EM_STEPS = 4.0, 0.3, 40


def estimate(patterns: dict[tuple[int, ...], int]) -> dict[tuple[int, ...], float]:
    """Chance of *private* for each vote pattern, by expectation maximisation (Dawid and Skene)
    from counts of patterns."""
    chance = [{v: list(_PRIOR[v]) for v in _PRIOR} for _ in LABELERS]
    private = _PRIOR_PRIVATE

    def posterior(votes: tuple[int, ...]) -> float:
        a = math.log(private) + sum(math.log(chance[k][v][0]) for k, v in enumerate(votes))
        b = math.log(1 - private) + sum(math.log(chance[k][v][1]) for k, v in enumerate(votes))
        return 1 / (1 + math.exp(min(700.0, b - a)))

    total = sum(patterns.values())
    for _ in range(EM_STEPS):
        belief = {votes: posterior(votes) for votes in patterns}
        yes = sum(n * belief[v] for v, n in patterns.items())
        private = (yes + _PRIOR_WEIGHT * _PRIOR_PRIVATE) / (total + _PRIOR_WEIGHT)
        for k in range(len(LABELERS)):
            for v in _PRIOR:
                seen = sum(n * belief[p] for p, n in patterns.items() if p[k] == v)
                other = sum(n * (1 - belief[p]) for p, n in patterns.items() if p[k] == v)
                chance[k][v] = [(seen + _PRIOR_WEIGHT * _PRIOR[v][0]) / (yes + _PRIOR_WEIGHT),
                                (other + _PRIOR_WEIGHT * _PRIOR[v][1]) / (total - yes + _PRIOR_WEIGHT)]
    return {votes: posterior(votes) for votes in patterns}


def train(found: DataFrame) -> tuple[float, dict[tuple[str, int], float]]:
    """Naive Bayes in log odds: the bias and the weight of every (feature, value)."""
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    votes = [f"v_{k}" for k in LABELERS]
    counted = each.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # 3**5 rows at most
    patterns = {tuple(r[v] for v in votes): r.n for r in counted}
    if not patterns:
        return -1.0, {}
    belief = estimate(patterns)
    p = reduce(lambda other, item: F.when(
        reduce(lambda a, b: a & b, [F.col(v) == x for v, x in zip(votes, item[0], strict=True)]), item[1]
    ).otherwise(other), sorted(belief.items()), F.lit(0.0))
    soft = each.withColumn("p", F.round(p, 9).cast("decimal(12,9)"))  # exact sums
    values = soft.select("p", F.explode(F.array(*[
        F.struct(F.lit(k).alias("name"), F.col(f"f_{k}").alias("value")) for k in FEATURES])).alias("f"))
    # a few values a feature
    rows = values.groupBy("f.name", "f.value").agg(F.sum("p").alias("yes"), F.count("*").alias("n")).collect()
    yes, total = float(sum(r.yes for r in rows if r.name == FEATURES[0])), sum(patterns.values())
    weights = {}
    for r in rows:
        own = float(r.yes)
        weights[r.name, r.value] = math.log((own + 0.5) / (yes + 1)) - math.log((r.n - own + 0.5) / (total - yes + 1))
    return math.log((yes + 0.5) / (total - yes + 0.5)), weights


def _accepted(c: Column, bias: float, weights: dict[tuple[str, int], float]) -> Column:
    odds = F.lit(bias)
    for name in FEATURES:
        own = F.lit(0.0)
        for (feature, value), weight in sorted(weights.items()):
            if feature == name:
                own = F.when(c[f"f_{name}"] == value, round(weight, 6)).otherwise(own)
        odds = odds + own
    # a vote of confidence beside the odds: some labeler must be for it. A listed stand-in is never a value,
    # however private the name before it is
    named = reduce(lambda a, b: a | b, [c[f"v_{k}"] == 1 for k in LABELERS])
    return (odds > 0) & named & (c["f_listed"] != -1)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (reads doc_id, text): doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_added.

    ``spans`` lists kind:start:end (code points, end exclusive) by kind, then start; added spans
    are of kind ``secret``, last, and overlap no base span. A null or empty text has none. Repeated
    rows have the same spans. An empty table gives no rows. A very long text is read whole; its spans cost
    about the power 1.5 of their number.
    """
    found = find(docs)
    bias, weights = train(found)
    out = found.withColumn("__added", F.filter("candidates", lambda c: _accepted(c, bias, weights)))

    def listed(kind: str, column: str) -> Column:
        return F.transform(column, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    base = F.concat(*[listed(k, f"__{k}") for k in KINDS])
    return out.select(
        "doc_id", *[F.size(f"__{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, listed(ADDED, "__added")), ",").alias("spans"),
        F.size("__added").cast("long").alias("n_added"))
