"""Secrets in texts: fixed patterns, and Markov models of characters.

Patterns find assigned values, access keys and long hex strings. Beside them, every run of at
least 16 token characters is scored by two first-order Markov models over characters, one of random
strings and one of ordinary identifiers: the mean log-likelihood ratio per
transition. Both are trained from labelled samples of the corpus: values inside pattern matches are
random; numbers, and runs that stand between different neighbours, are ordinary. Copies of a document, exact or
near, have a run between the same neighbours, so a secret in them does not pass for ordinary. Both models
compete with a third, that the run repeats itself: a transition that came before in the run is no
sign of chance. The threshold lies above all but a thousandth of the ordinary runs and
never below equal likelihood.

DataFrame functions only. Texts are read once; what was found in them is written to a table, from which
the models are counted and the runs are scored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm._scratch import spool
from tidemill.llm._spans import SPANS, as_spans, count_kind, find_matches, overlaps, written

KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGNED_CHARS = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
#: Runs that the models score.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
#: Of ordinary runs, the share that may score above the threshold.
FALSE_ALARMS = 0.001
#: The weight of one unseen character.
PRIOR = 0.5
#: After each character so many transitions are taken to be as frequent as their second characters are.
BACKED = 16.0
#: An ordinary run has so many different texts before it, and so many after it, or more.
NEIGHBOURS = 3
#: Code points of a run's surroundings that are compared.
CONTEXT = 12
#: How likely a run that repeats itself goes on with a certain transition it has had.
REPEATED = 0.5

#: Character classes: letters each, digits, and the rest together; upper case apart.
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_N = len(_ALPHABET)


def _found(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    assigned = F.when(F.col("text").contains("=") | F.col("text").contains(":"), F.col("text")).otherwise(F.lit(""))
    access = F.when(F.col("text").contains("AKIA"), F.col("text")).otherwise(F.lit(""))
    texts = texts.select("doc_id", "text", assigned.alias("with_sign"), access.alias("with_key"))
    patterns = {"assign": ("with_sign", ASSIGN), "access": ("with_key", ACCESS), "hex": ("text", HEX), "token": ("text", TOKEN)}
    return find_matches(texts, patterns).select(
        "doc_id",
        F.filter("assign", lambda m: F.char_length(F.regexp_extract(m["text"], ASSIGN, 2)) >= ASSIGNED_CHARS).alias("assign"),
        "access",
        "hex",
        F.transform("token", _in_context).alias("token"),
    )


def _in_context(match: Column) -> Column:
    """A match with hashes of the code points on either side."""
    start, end = match["start"], match["end"]
    before = F.col("text").substr(F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
    after = F.col("text").substr(end + 1, F.lit(CONTEXT))
    return F.struct(start.alias("start"), end.alias("end"), match["text"].alias("text"), F.xxhash64(before).alias("before"), F.xxhash64(after).alias("after"))


def _transitions(token: Column) -> Column:
    """Index of each pair of neighbouring characters in the table of transitions."""
    places = F.transform(F.sequence(F.lit(1), F.char_length(token)), lambda i: F.position(token.substr(i, F.lit(1)), F.lit(_ALPHABET)) - 1)
    rest = F.size(places) - 1
    return F.zip_with(F.slice(places, F.lit(1), rest), F.slice(places, F.lit(2), rest), lambda a, b: a * _N + b)


def _log_likelihoods(counts: dict[int, int]) -> list[float]:
    """Log-probability of each transition given its first character, backed by the frequency of its second."""
    sums = [sum(counts.get(a * _N + b, 0) for b in range(_N)) for a in range(_N)]
    second = [sum(counts.get(a * _N + b, 0) for a in range(_N)) + PRIOR for b in range(_N)]
    shares = [n / sum(second) for n in second]
    return [math.log((counts.get(a * _N + b, 0) + BACKED * shares[b]) / (sums[a] + BACKED)) for a in range(_N) for b in range(_N)]


def _labelled(found: DataFrame) -> DataFrame:
    """(token, random, n): values inside pattern matches; numbers, and runs between different neighbours, outside them.

    An ordinary run counts once for each of its neighbours on the side that has fewer.
    """
    base = F.concat(as_spans(F.col("assign"), 0), as_spans(F.col("access"), 1), as_spans(F.col("hex"), 2))
    values = F.concat(
        F.transform("assign", lambda m: F.regexp_extract(m["text"], ASSIGN, 2)), F.transform("access", lambda m: m["text"]), F.transform("hex", lambda m: m["text"])
    )
    outside = F.filter("token", lambda m: ~overlaps(base, m["start"], m["end"]))
    random = found.select(F.explode(values).alias("token"), F.lit(True).alias("random"), F.lit(1).cast("long").alias("n"))
    random = random.withColumn("token", F.regexp_replace("token", r"[^A-Za-z0-9+/_=-]", ""))
    runs = found.select(F.explode(outside).alias("m")).select("m.text", "m.before", "m.after")
    # Each neighbour of a run once, before they are counted.
    sides = runs.select("text", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("near")), F.struct(F.lit(1).alias("side"), F.col("after").alias("near")))).alias("s"))
    sides = sides.select("text", "s.side", "s.near").distinct().groupBy("text", "side").agg(F.count(F.lit(1)).alias("near"))
    ordinary = sides.groupBy(F.col("text").alias("token")).agg(F.min("near").alias("n"))
    ordinary = ordinary.filter((F.col("n") >= NEIGHBOURS) | F.col("token").rlike("^[0-9]+$"))
    return random.unionByName(ordinary.select("token", F.lit(False).alias("random"), "n")).filter(F.char_length("token") >= 2)


class SecretModel:
    """Log-likelihood ratio of each transition, the one it has when it repeats, and the threshold of the mean."""

    def __init__(self, ratios: list[float], repeats: list[float], threshold: float):
        self.ratios, self.repeats, self.threshold = ratios, repeats, threshold

    def score(self, token: Column) -> Column:
        all_of = _transitions(token)
        repeats = F.array(*map(F.lit, self.repeats))
        gains = F.array(*(F.lit(a - b) for a, b in zip(self.ratios, self.repeats, strict=True)))
        # A transition counts by the two models where it comes first, and as a repetition after that.
        total = F.aggregate(all_of, F.lit(0.0), lambda acc, i: acc + F.get(repeats, i.cast("int")))
        total = F.aggregate(F.array_distinct(all_of), total, lambda acc, i: acc + F.get(gains, i.cast("int")))
        return total / (F.char_length(token) - 1)


def _train(found: DataFrame) -> SecretModel:
    labelled = _labelled(found)
    counted = (
        labelled.select("random", "n", F.explode(_transitions(F.col("token"))).alias("transition"))
        .groupBy("random", "transition")
        .agg(F.sum("n").alias("n"))
    )
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for row in counted.collect():  # at most two for each pair of characters
        counts[row["random"]][row["transition"]] = row["n"]
    if not counts[True] or not counts[False]:
        return SecretModel([0.0] * (_N * _N), [0.0] * (_N * _N), math.inf)  # nothing to learn from: no added spans
    chance = _log_likelihoods(counts[True])
    ratios = [a - b for a, b in zip(chance, _log_likelihoods(counts[False]), strict=True)]
    # Chance hits a certain character as often as any other.
    repeats = [min(r, -math.log(_N) - math.log(REPEATED)) for r in ratios]
    model = SecretModel(ratios, repeats, 0.0)
    # Rounded up, so that the exact percentile holds few different scores.
    scores = labelled.filter("NOT random").select((F.ceil(model.score(F.col("token")) * 1000) / 1000).alias("score"), "n")
    high = float(scores.agg(F.percentile("score", 1 - FALSE_ALARMS, F.col("n"))).head()[0])
    return SecretModel(ratios, repeats, max(0.0, high))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans of every row of ``docs`` (doc_id, text).

    ``base`` and ``added`` are arrays of (start, kind, end): code points, end exclusive, kind an index of
    KINDS. Null counts as empty, and an empty text has no spans. Copies of a row get the same spans as it
    alone would; the models come from all rows. Without labelled runs of both sorts nothing is
    added. Other columns are not looked at.
    """
    found = spool(_found(docs), "secrets")
    model = _train(found)
    base = F.concat(as_spans(F.col("assign"), 0), as_spans(F.col("access"), 1), as_spans(F.col("hex"), 2))
    found = found.select("doc_id", "token", F.array_sort(base).alias("base"))
    open_runs = F.filter("token", lambda m: ~overlaps(F.col("base"), m["start"], m["end"]))
    likely = F.filter(open_runs, lambda m: model.score(m["text"]) > F.lit(float(model.threshold)))
    return found.select("doc_id", "base", as_spans(likely, 3).cast(SPANS).alias("added"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts by kind, digest of the base spans, and all spans as text."""
    count = [count_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return found.select(
        "doc_id",
        *count,
        F.size("added").cast("long").alias("n_markov"),
        F.sha2(written(F.col("base"), KINDS), 256).alias("base_sha256"),
        written(F.concat("base", "added"), KINDS).alias("spans"),
    )
