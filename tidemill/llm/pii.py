"""Personal data in texts: fixed patterns, and boosted trees over proposed spans.

Patterns find e-mail addresses, IP addresses, card and phone numbers, each with its check. Beside
them, generators with high recall propose spans that may overlap: anything around an
at-sign or its spellings, any long group of digits, any dotted numbers. Each candidate is described by
binned format and context features. Labels come from the patterns: a candidate that overlaps a match is
personal data. One that a pattern could have matched, but did not (a card number that fails its check), is
not, nor is one that nothing speaks for. What no pattern can match but has a cue or a telling form, an address
that spells out its at-sign or a phone number without a plus, is without a label and trains nothing.
Neither the check of a pattern (Luhn, ranges) nor the sign that it asks for is a feature, so the trees learn
what such data look like otherwise and what stands around them. A candidate is added as a span if its
probability reaches the threshold of its generator, unless it overlaps a match; thresholds come from candidates
of a fold of documents that the trees did not see.

DataFrame functions only. Texts are read once; candidates are written to a table. Training needs
only the counts of label by feature values, whose number is bounded by the bins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm._scratch import spool
from tidemill.llm._spans import MATCHES, as_spans, count_kind, find_matches, leftmost, overlaps, written

KINDS = ["email", "ip", "card", "phone", "model"]

# The patterns below say the same as the plain ones, but never repeat a group, which would
# take stack by the length of the text, and never try a run of characters from its middle.
# MARK stands for a dot that no label follows, and for a separator between digits.
_MARK = "\x01"
_LOCAL = rf"[A-Za-z0-9._%+{_MARK}-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = rf"[0-9][0-9{_MARK}]{{11,}}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

GENERATORS = {
    "contact": r"[^\s@<>()\[\]]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[^\s@<>()\[\]]{1,255}",
    "digits": r"\+?\(?[0-9][0-9\x20().-]{7,}[0-9]",
    "dotted": r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,7}(?![0-9])",
}
#: Code points before a candidate that are looked at.
CONTEXT = 24
ROUNDS = 24
RATE = 0.3
#: Share of the held-out candidates at or above a threshold that has to be personal data.
PRECISION = 0.97
#: One document of so many is held out for the thresholds.
FOLDS = 4

#: feature -> number of bins; the product bounds the table of counts.
BINS = {"generator": 3, "digits": 6, "length": 5, "separators": 3, "dots": 4, "before": 4, "after": 4, "cue": 2, "letters": 3, "date": 2}


def _pattern_columns(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    clean = F.translate(F.col("text"), _MARK, "\x02")
    none = F.lit("")
    with_digits = F.when(F.col("text").rlike("[0-9]"), F.col("text")).otherwise(none)
    rows = rows.select("doc_id", "text", with_digits.alias("numbers"), F.when(F.col("text").contains("@"), clean).otherwise(none).alias("mails"))
    return rows.select(
        "doc_id",
        "text",
        "numbers",
        F.regexp_replace("mails", r"\.(?![A-Za-z0-9-])", _MARK).alias("mails"),
        F.regexp_replace(F.translate(F.col("numbers"), _MARK, "\x02"), r"(?<=[0-9])[\x20-](?=[0-9])", _MARK).alias("cards"),
        F.when(F.col("text").contains("+"), F.col("text")).otherwise(none).alias("phones"),
        F.when(F.col("text").contains("@") | F.col("text").rlike(r"\(at\)|\[at\]"), F.col("text")).otherwise(none).alias("contacts"),
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added up: a multiple of ten."""

    def add(total: Column, i: Column) -> Column:
        digit = digits.substr(F.char_length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(i % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _valid_card(match: Column) -> Column:
    digits = F.translate(match, _MARK, "")
    size = F.char_length(digits)
    return F.when((size >= 12) & (size <= 19), passes_luhn(digits)).otherwise(F.lit(False))


def _valid_phone(match: Column) -> Column:
    return F.char_length(_digits(match)).between(9, 15)


def _found(docs: DataFrame) -> DataFrame:
    """doc_id, matches that pass by kind, candidates with features."""
    patterns = {"email": ("mails", EMAIL), "ip": ("numbers", IP), "card": ("cards", CARD), "phone": ("phones", PHONE)}
    patterns |= {"contact": ("contacts", GENERATORS["contact"]), "digits": ("numbers", GENERATORS["digits"]), "dotted": ("numbers", GENERATORS["dotted"])}
    rows = find_matches(_pattern_columns(docs), patterns)
    rows = rows.select(
        "doc_id",
        "text",
        as_spans(F.col("email"), 0).alias("email"),
        as_spans(F.filter("ip", lambda m: m["text"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")), 1).alias("ip"),
        as_spans(F.filter("card", lambda m: _valid_card(m["text"])), 2).alias("card"),
        as_spans(F.filter("phone", lambda m: _valid_phone(m["text"])), 3).alias("phone"),
        "contact",
        "digits",
        "dotted",
    )
    rows = rows.select("doc_id", "text", F.array_sort(F.concat("email", "ip", "card", "phone")).alias("base"), "contact", "digits", "dotted")
    candidates = F.concat(*(_described(F.col(name), n) for n, name in enumerate(GENERATORS)))
    return rows.select("doc_id", "base", candidates.alias("candidates"))


def _bin(value: Column, *edges: int) -> Column:
    """How many of the edges the value reaches."""
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), F.lit(0))


def _kind_of(char: Column) -> Column:
    return F.when((char == "") | char.rlike(r"^\s"), 0).when(char.rlike("^[0-9]"), 1).when(char.rlike(r"^\p{L}"), 2).otherwise(3)


#: By generator: whether a pattern could match such a text, and whether its form alone speaks for it.
_MATCHABLE = [
    lambda text: text.contains("@"),
    lambda text: text.startswith("+") | (F.char_length(_digits(text)) >= 12),
    lambda text: text.rlike(r"^[0-9]+(\.[0-9]+){3}"),
]
_TELLING = [
    lambda text: text.rlike(r"(\(at\)|\[at\])\x20?[A-Za-z0-9-]+\.[A-Za-z]"),
    lambda text: text.rlike(r"^\([0-9]{2,5}\)\x20?[0-9]"),
    lambda text: F.lit(False),
]


def _described(matches: Column, generator: int) -> Column:
    def describe(m: Column) -> Column:
        text = m["text"]
        start, end = m["start"], m["end"]
        context = F.col("text").substr(F.greatest(start - CONTEXT + 1, F.lit(1)), F.least(start, F.lit(CONTEXT)))
        separators = F.char_length(F.regexp_replace(text, r"[^\x20()-]", ""))
        letters = F.char_length(F.regexp_replace(text, "[^A-Za-z]", ""))
        cued = context.rlike(r"(?i)mail|phone|tel|call|card|contact|\bip\b|address")
        label = overlaps(F.col("base"), start, end)
        return F.struct(
            start.alias("start"),
            end.alias("end"),
            label.alias("label"),
            (~label & ~_MATCHABLE[generator](text) & (cued | _TELLING[generator](text))).alias("unsure"),
            F.lit(generator).alias("generator"),
            _bin(F.char_length(_digits(text)), 1, 8, 9, 12, 16).alias("digits"),
            _bin(end - start, 8, 12, 16, 24).alias("length"),
            _bin(separators, 1, 3).alias("separators"),
            _bin(F.char_length(F.regexp_replace(text, r"[^.]", "")), 1, 2, 3).alias("dots"),
            _kind_of(F.col("text").substr(start, F.when(start > 0, 1).otherwise(0))).alias("before"),
            _kind_of(F.col("text").substr(end + 1, F.lit(1))).alias("after"),
            F.when(cued, 1).otherwise(0).alias("cue"),
            _bin(letters, 1, 6).alias("letters"),
            F.when(text.rlike(r"^(?:19|20)[0-9]{2}[-. ][0-9]{1,2}[-. ][0-9]{1,2}"), 1).otherwise(0).alias("date"),
        )

    return F.transform(matches.cast(MATCHES), describe)


Row = tuple[tuple[int, ...], float, float]  # feature values, candidates, of them personal data


@dataclass(frozen=True)
class Split:
    """Leaf values of a tree of two levels: (feature, bin) at the top and below either side."""

    top: tuple[int, int]
    low: tuple[int, int]
    high: tuple[int, int]
    values: tuple[float, float, float, float]

    def leaf(self, row: tuple[int, ...]) -> int:
        upper = row[self.top[0]] >= self.top[1]
        feature, at = self.high if upper else self.low
        return 2 * upper + (row[feature] >= at)


def _best(rows: list[tuple[tuple[int, ...], float, float]]) -> tuple[int, int]:
    """The cut with the largest gain from (features, gradient, weight)."""
    best, gain = (0, 0), -1.0
    sum_g, sum_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    for feature, bins in enumerate(BINS.values()):
        left_g, left_h = [0.0] * (bins + 1), [0.0] * (bins + 1)
        for values, g, h in rows:
            left_g[values[feature]] += g
            left_h[values[feature]] += h
        g = h = 0.0
        for cut in range(1, bins):
            g, h = g + left_g[cut - 1], h + left_h[cut - 1]
            score = g * g / (h + 1) + (sum_g - g) ** 2 / (sum_h - h + 1)
            if score > gain:
                best, gain = (feature, cut), score
    return best


@dataclass(frozen=True)
class Booster:
    trees: tuple[Split, ...]
    bias: float
    #: By generator.
    thresholds: tuple[float, ...]

    def raw(self, row: tuple[int, ...]) -> float:
        return self.bias + sum(t.values[t.leaf(row)] for t in self.trees)

    def probability(self, candidate: Column) -> Column:
        """The same as a column over the features of a candidate."""
        names = list(BINS)

        def reaches(cut: tuple[int, int]) -> Column:
            return candidate[names[cut[0]]] >= cut[1]

        total = F.lit(self.bias)
        for t in self.trees:
            low = F.when(reaches(t.low), t.values[1]).otherwise(t.values[0])
            high = F.when(reaches(t.high), t.values[3]).otherwise(t.values[2])
            total = total + F.when(reaches(t.top), high).otherwise(low)
        return 1 / (1 + F.exp(-total))

    def accepts(self, candidate: Column) -> Column:
        """Whether the probability reaches the threshold of the candidate's generator."""
        thresholds = F.array(*(F.lit(float(t)) for t in self.thresholds))
        return self.probability(candidate) >= F.get(thresholds, candidate["generator"])


def boost(rows: list[Row], held_out: list[Row] | None = None, rounds: int = ROUNDS, rate: float = RATE) -> Booster:
    """Gradient-boosted trees on counted rows, thresholds from held-out ones (without these, from the same).

    A generator's threshold is the lowest probability from which on the share of personal data is at
    least PRECISION, one half at least. Without personal data nothing reaches it; where there is
    nothing else, candidates are as likely as one in the number of rows and two is not.
    """
    total, positive = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not positive:
        return Booster((), 0.0, (math.inf,) * BINS["generator"])
    bias = math.log((positive + 1) / (total - positive + 1))
    trees: list[Split] = []
    scores = [bias] * len(rows)
    for _ in range(rounds if positive < total else 0):
        chances = [1 / (1 + math.exp(-s)) for s in scores]
        state = [(v, y - n * p, n * p * (1 - p)) for (v, n, y), p in zip(rows, chances, strict=True)]
        top = _best(state)
        sides = [[r for r in state if (r[0][top[0]] >= top[1]) == upper] for upper in (False, True)]
        cuts = [_best(side) for side in sides]
        values = []
        for side, (feature, at) in zip(sides, cuts, strict=True):
            for upper in (False, True):
                leaf = [r for r in side if (r[0][feature] >= at) == upper]
                values.append(rate * sum(r[1] for r in leaf) / (sum(r[2] for r in leaf) + 1))
        tree = Split(top, cuts[0], cuts[1], tuple(values))
        trees.append(tree)
        scores = [s + tree.values[tree.leaf(r[0])] for s, r in zip(scores, rows, strict=True)]
    model = Booster(tuple(trees), bias, ())
    judged = [(model.raw(r[0]), r) for r in held_out or rows]
    generator = list(BINS).index("generator")
    thresholds = [_threshold([x for x in judged if x[1][0][generator] == g]) for g in range(BINS["generator"])]
    return Booster(model.trees, model.bias, tuple(thresholds))


def _threshold(judged: list[tuple[float, Row]]) -> float:
    ranked = sorted(judged, key=lambda x: -x[0])
    threshold, seen, right = math.inf, 0.0, 0.0
    for n, (score, row) in enumerate(ranked):
        seen, right = seen + row[1], right + row[2]
        last_of_score = n + 1 == len(ranked) or ranked[n + 1][0] < score
        if last_of_score and right and right >= PRECISION * seen:
            threshold = 1 / (1 + math.exp(-score))
    return max(0.5, threshold - 1e-9)


def _train(found: DataFrame) -> Booster:
    """Trees from candidates with a label; the unsure ones are in neither part."""
    counted = (
        found.select((F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0).alias("held_out"), F.explode("candidates").alias("c"))
        .filter("NOT c.unsure")
        .groupBy("held_out", *(F.col(f"c.{name}").alias(name) for name in BINS))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c.label").cast("int")).alias("positive"))
    )
    parts: dict[bool, list[Row]] = {False: [], True: []}
    for r in counted.collect():  # bounded by BINS
        parts[r["held_out"]].append((tuple(r[1 : 1 + len(BINS)]), float(r["n"]), float(r["positive"])))
    return boost(sorted(parts[False]), sorted(parts[True]))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base and added spans of every row of ``docs`` (doc_id, text).

    ``base`` and ``added`` are arrays of (start, kind, end): code points, end exclusive, kind an index of
    KINDS. Spans of different kinds may overlap in ``base``; added ones overlap nothing. Null counts as empty, and an
    empty text has no spans. Rows are independent; the trees come from all
    candidates. Without matches nothing is added. Copies of a row get the same spans. Other columns are not looked at.
    """
    found = spool(_found(docs), "pii")
    model = _train(found)
    open_ones = F.filter("candidates", lambda c: ~c["label"])
    likely = F.filter(open_ones, model.accepts)
    return found.select("doc_id", "base", leftmost(as_spans(likely, 4)).alias("added"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts by kind, digest of the base spans, and all spans as text."""
    return found.select(
        "doc_id",
        *(count_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.size("added").cast("long").alias("n_model"),
        F.sha2(written(F.col("base"), KINDS), 256).alias("base_sha256"),
        written(F.concat("base", "added"), KINDS).alias("spans"),
    )
