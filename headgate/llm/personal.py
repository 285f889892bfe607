"""Personal data by weak supervision, on DataFrame functions only.

Candidates are the matches of four strict patterns, which are always reported, and of looser ones
(written-out addresses, other groupings of digits), which are reported if the method says so. Five
labelers vote on every candidate, each for, against or not at all: its pattern, a check of its
parts, a gazetteer, the words before it, and the characters around it. Expectation-maximisation
estimates how reliable each labeler is for each kind, without labels; the probabilities it gives to
the candidates then train the span classifier, a naive Bayes model over features of the span.

Whatever is learned is learned from counts of distinct vote-and-feature patterns, of which there are
boundedly many whatever the corpus is; the driver sees these counts only. The classifier comes back
as a literal map, so that candidates are judged where they are, in the row of their text.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.llm.tables import kept

#: The kinds in their order, and their patterns. Look-behind with \G (or the end of
#: the match before) and possessive quantifiers keep the matches and make them linear in the text; a card's pattern asks
#: for its 16 digits at once, as shorter runs of digits are dropped anyway.
KINDS = ("email", "ip", "card", "phone")
STRICT = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9]){15,}+",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
LOOSE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}| at ) ?[A-Za-z0-9-]++"
    r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++| dot [A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
    r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    r"(?<![0-9.-])(?:3[47][0-9]{2}[ .-]?[0-9]{6}[ .-]?[0-9]{5}|(?:[0-9]{4}[._/]){3}[0-9]{4})(?![0-9])",
    r"(?<![0-9A-Za-z+.-])(?:00[1-9][0-9 ().-]{7,17}[0-9]|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])",
)
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Gazetteers and cues. A pattern that a candidate or the text before it should have,
#: and one that speaks against it.
LISTED = (
    (r"(?i)(?:\.|dot |dot\) ?|dot\] ?|dot\} ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us|ca|ch|at|it|nl)$", None),
    (None, r"^(?:0|10|127|169\.254|192\.168|224|255)\."),
    (r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)", r"^0"),
    (r"^(?:\+|00)(?:1|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|^\(?[2-9]", None),
)
CUES = (
    (r"(?i)(?:e-?mail|correo|courriel|contact|write|mailto)[^a-z]*$", r"(?i)(?:look|arrive|stay|see)[^a-z]*$"),
    (r"(?i)(?:\bip|address|host|server|from)[^a-z0-9]*$", r"(?i)(?:version|\bv|release|section|build)[^a-z0-9]*$"),
    (r"(?i)(?:card|visa|master|amex|credit|karte|tarjeta|carte)[^a-z0-9]*$", r"(?i)(?:order|invoice|isbn|serial|token|key|id)[^a-z0-9]*$"),
    (r"(?i)(?:phone|tel|call|fax|mobile|cell|whatsapp|numéro|telefon|teléfono)[^a-z0-9]*$", r"(?i)(?:order|invoice|isbn|serial|token|key|id)[^a-z0-9]*$"),
)
BEFORE = 32
ROUNDS = 40
#: Probability from which a loose candidate is reported.
THRESHOLD = 0.9

FEATURES = ("length", "digits", "left", "right", "cue")


def _before(df: DataFrame, columns: list[str], fold: Callable[[Column, Column], Column]) -> DataFrame:
    """Each array of numbers replaced by what `fold` makes of the elements before each, from 0 on.

    In blocks of about the square root of the length, so that long arrays do not cost their square.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    width = {c: F.greatest(F.ceil(F.sqrt(F.size(c))).cast("int"), F.lit(1)) for c in columns}
    zero = F.lit(0)

    def block(c: str) -> Column:
        last = F.floor((F.size(c) - 1) / width[c]).cast("int")
        return F.transform(F.sequence(zero, last), lambda b: F.aggregate(F.slice(c, b * width[c] + 1, width[c]), zero, fold))

    df = df.select(*others, *columns, *[F.when(F.size(c) > 0, block(c)).alias(f"{c}_blocks") for c in columns])
    bases = [_bases(f"{c}_blocks", fold).alias(f"{c}_bases") for c in columns]
    df = df.select(*others, *columns, *bases)
    return df.select(*others, *[_inner(c, width[c], fold).alias(c) for c in columns])


def _bases(blocks: str, fold: Callable[[Column, Column], Column]) -> Column:
    return F.transform(blocks, lambda _, b: F.aggregate(F.slice(blocks, F.lit(1), b), F.lit(0), fold))


def _inner(column: str, width: Column, fold: Callable[[Column, Column], Column]) -> Column:
    def one(_: Column, i: Column) -> Column:
        base = F.get(F.col(f"{column}_bases"), F.floor(i / width).cast("int"))
        return F.aggregate(F.slice(column, i - i % width + 1, i % width), base, fold)

    return F.transform(column, one)


def _located(k: int) -> Column:
    """Matches of a pattern with code point offset and the text around them."""
    gaps = F.col(f"_gaps{k}")

    def one(hit: Column, i: Column) -> Column:
        gap = F.get(gaps, i)
        start = F.get(F.col(f"_at{k}"), i) + F.length(gap)
        before, after = F.right(gap, F.lit(BEFORE)), F.left(F.get(gaps, i + 1), F.lit(1))
        return F.struct(start.alias("start"), hit.alias("hit"), before.alias("before"), after.alias("after"))

    return F.transform(f"_hits{k}", one)


def _passage(k: int) -> Column:
    """Length of each match with the piece before it."""
    gaps = F.col(f"_gaps{k}")
    return F.transform(f"_hits{k}", lambda hit, i: F.length(F.get(gaps, i)) + F.length(hit))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a run of digits has a valid check digit."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: int, hit: Column) -> Column:
    """What a strict match must pass besides its pattern."""
    n = F.length(_digits(hit))
    if kind == 1:
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == 2:
        return F.when(n.between(16, 19), luhn(_digits(hit))).otherwise(F.lit(False))
    return n.between(8, 15) if kind == 3 else F.lit(True)


def _passed(kind: int, x: Column) -> Column:
    return _valid(kind, x["hit"])


def _checked(kind: int, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == 0:
        return ~hit.rlike(r"\.\.|^\.|--")
    if kind == 1:
        return ~hit.rlike(r"(?:^|\.)0[0-9]")
    return n.between(10, 13) if kind == 3 else F.when(n.between(15, 19), luhn(_digits(hit))).otherwise(F.lit(False))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, "y").when(bad, "n").otherwise("-")


def _matches(value: Column, pattern: str | None) -> Column:
    return value.rlike(pattern) if pattern else F.lit(False)


def _edge(char: Column) -> Column:
    return F.when(char == "", "o").when(char.rlike(r"[\p{L}\p{N}]"), "a").when(char.rlike(r"\s"), "s").otherwise("p")


def _described(strict: bool, kind: int, x: Column) -> Column:
    """The candidate with its five votes and the values of its features."""
    hit, before, after = x["hit"], x["before"], x["after"]
    good = F.lit(strict)
    checked = _checked(kind, hit)
    glued = before.rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]")
    cue = _vote(_matches(before, CUES[kind][0]), _matches(before, CUES[kind][1]))
    votes = F.concat(
        _vote(good, F.lit(False)), _vote(checked, ~checked),
        _vote(_matches(hit, LISTED[kind][0]), _matches(hit, LISTED[kind][1])), cue, _vote(~glued, glued),
    )
    n = F.length(hit)
    values = F.concat(
        F.least(F.floor(n / 6), F.lit(5)).cast("string"),
        F.floor(4 * F.length(_digits(hit)) / n).cast("string"),
        _edge(F.right(before, F.lit(1))), _edge(after), cue,
    )
    return F.struct(
        F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + n).alias("stop"),
        F.lit(strict).alias("strict"), votes.alias("votes"), values.alias("features"),
    )


def _each(column: str, make: Callable[[int, Column], Column], kind: int) -> Column:
    return F.transform(column, lambda x: make(kind, x))


def candidates(documents: DataFrame, text: str = "text", into: str = "candidates") -> DataFrame:
    """`documents` with an array of all candidates: strict matches, and loose ones that touch none.

    Each step is a projection of its own, so that what a later one uses often is computed once.
    """
    own = [F.col(f"`{c}`") for c in documents.columns]
    kinds = range(len(KINDS))
    patterns = [*STRICT, *LOOSE]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    now = documents.select(*own, *[F.regexp_extract_all(value, F.lit(p), F.lit(0)).alias(f"_hits{k}") for k, p in enumerate(patterns)])
    # The pieces between the matches come from the same matches; most texts have none.
    gaps = [F.when(F.size(f"_hits{k}") > 0, F.split(value, p, -1)).alias(f"_gaps{k}") for k, p in enumerate(patterns)]
    every = range(len(patterns))
    now = now.select(*own, *[f"_hits{k}" for k in every], *gaps)
    now = now.select("*", *[_passage(k).alias(f"_at{k}") for k in every])
    now = _before(now, [f"_at{k}" for k in every], lambda a, x: a + x)
    now = now.select(*own, *[_located(k).alias(f"_found{k}") for k in every])
    passed = [F.filter(f"_found{k}", partial(_passed, k)).alias(f"_strict{k}") for k in kinds]
    now = now.select(*own, *passed, *[F.col(f"_found{k + len(KINDS)}").alias(f"_loose{k}") for k in kinds])
    strict = [_each(f"_strict{k}", partial(_described, True), k) for k in kinds]
    loose = [_each(f"_loose{k}", partial(_described, False), k) for k in kinds]
    now = now.select(*own, F.concat(*strict).alias("_sure"), F.concat(*loose).alias("_more"))

    def apart(x: Column) -> Column:
        return ~F.exists("_sure", lambda s: (s["start"] < x["stop"]) & (x["start"] < s["stop"]))

    return now.select(*own, F.concat("_sure", F.filter("_more", apart)).alias(into))


def _reliabilities(seen: dict[tuple[int, str], float]) -> dict[tuple[int, str], float]:
    """Probability of each (kind, votes) to be personal data, by expectation-maximisation."""
    belief = {p: 1 / (1 + math.exp(p[1].count("n") - p[1].count("y"))) for p in seen}
    for _ in range(ROUNDS):
        mass = defaultdict(lambda: 1.0)  # one of each vote, so that nothing is impossible
        for (kind, votes), n in seen.items():
            for y, share in ((1, belief[kind, votes]), (0, 1 - belief[kind, votes])):
                mass[kind, y] += n * share
                for labeler, vote in enumerate(votes):
                    mass[kind, y, labeler, vote] += n * share

        def log_odds(kind: int, votes: str, mass: dict = mass) -> float:
            odds = math.log(mass[kind, 1] / mass[kind, 0])
            for labeler, vote in enumerate(votes):
                odds += math.log(mass[kind, 1, labeler, vote] / (mass[kind, 1] + 2))
                odds -= math.log(mass[kind, 0, labeler, vote] / (mass[kind, 0] + 2))
            return max(-30.0, min(30.0, odds))

        belief = {p: 1 / (1 + math.exp(-log_odds(*p))) for p in seen}
    return belief


def train(found: DataFrame) -> dict[str, float]:
    """Weights of the span classifier by `kind:place:value` (and `kind` for the prior), from candidates.

    `found` has one array `candidates` per row. Only pattern counts reach the driver.
    """
    each = found.select(F.explode("candidates").alias("c"))
    rows = each.groupBy("c.kind", "c.votes", "c.features").count().collect()
    seen: dict[tuple[int, str], float] = defaultdict(float)
    for kind, votes, _, n in rows:
        seen[kind, votes] += n
    belief = _reliabilities(seen)
    mass: dict[tuple, float] = defaultdict(lambda: 0.5)
    for kind, votes, features, n in rows:
        for y, share in ((1, belief[kind, votes]), (0, 1 - belief[kind, votes])):
            mass[kind, y] += n * share
            for place, value in enumerate(features):
                mass[kind, place, value, y] += n * share
    weights = {}
    for kind, _, features, _ in rows:
        weights[str(kind)] = math.log(mass[kind, 1] / mass[kind, 0])
        for place, value in enumerate(features):
            ratio = mass[kind, place, value, 1] * mass[kind, 0] / (mass[kind, place, value, 0] * mass[kind, 1])
            weights[f"{kind}:{place}:{value}"] = math.log(ratio)
    return weights


def _probability(weights: dict[str, float]) -> Callable[[Column], Column]:
    if not weights:
        return lambda c: F.lit(0.0)
    table = F.create_map(*[F.lit(v) for pair in sorted(weights.items()) for v in pair])

    def of(c: Column) -> Column:
        kind = c["kind"].cast("string")
        odds = F.coalesce(F.try_element_at(table, kind), F.lit(0.0))
        for place in range(len(FEATURES)):
            key = F.concat(kind, F.lit(f":{place}:"), F.substr(c["features"], F.lit(place + 1), F.lit(1)))
            odds = odds + F.coalesce(F.try_element_at(table, key), F.lit(0.0))
        return 1 / (1 + F.exp(-odds))

    return of


def _reported(weights: dict[str, float], threshold: float) -> Column:
    """The candidates that are personal data, by kind and then start."""
    sure = _probability(weights)
    chosen = F.filter("candidates", lambda c: c["strict"] | (sure(c) >= threshold))
    return F.array_sort(F.transform(chosen, lambda c: F.struct(c["kind"], c["start"], c["stop"], c["strict"])))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def _of_kind(kind: int, span: Column) -> Column:
    return span["kind"] == kind


def find_personal(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans` for every row of `documents`.

    The counts and the digest are those of the strict matches, `spans` has these and the added
    ones. Offsets are code points, ends exclusive. A null or empty text has no spans. Rows stand
    for themselves, so repeated rows and null ids get rows of their own; ties do not arise, as
    matches of a pattern never overlap. Other columns are left unread, an empty table gives no rows.
    """
    found = kept(candidates(documents.select("doc_id", "text")).drop("text"), "op9-candidates")
    spans = found.select("doc_id", _reported(train(found), threshold).alias("all"))
    base = F.filter("all", lambda s: s["strict"])
    counts = [F.size(F.filter(base, partial(_of_kind, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("all")).alias("spans"))


def _masked(text: str) -> Column:
    """The text with every one of `_spans` replaced by its kind; overlapping ones by the first's."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(s: Column, i: Column) -> Column:
        reached = F.get(F.col("_reached"), i)
        fresh = F.concat(F.substr(F.col(text), reached + 1, s["start"] - reached), F.get(names, s["kind"]))
        return F.when(s["start"] >= reached, fresh).otherwise("")

    rest = F.substr(F.col(text), F.array_max(F.transform("_spans", lambda s: s["stop"])) + 1, F.length(text))
    return F.when(F.size("_spans") > 0, F.concat(F.array_join(F.transform("_spans", piece), ""), rest)).otherwise(F.col(text))


def mask_personal(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with personal data masked, `n_chars` set anew where the text has changed."""
    own = documents.columns
    plain = documents.toDF(*[f"c{k}" for k in range(len(own))])
    text = f"c{own.index('text')}"
    marked = kept(candidates(plain, text), "op9-marked")  # found once: for the classifier, and to be masked
    spans = _reported(train(marked.select("candidates")), threshold)
    by_start = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
    found = marked.select(*plain.columns, F.array_sort(by_start).alias("_spans"))
    found = found.select("*", F.transform("_spans", lambda s: s["stop"]).alias("_reached"))
    found = _before(found, ["_reached"], lambda a, x: F.greatest(a, x))
    found = found.select(*plain.columns, _masked(text).alias("masked"))
    changed = F.col("masked") != F.col(text)
    values = {c: F.col(c) for c in plain.columns} | {text: F.col("masked")}
    if "n_chars" in own:
        n = f"c{own.index('n_chars')}"
        values[n] = F.when(changed, F.length("masked")).otherwise(F.col(n)).cast(plain.schema[n].dataType)
    return found.select(*[v.alias(c) for c, v in zip(own, values.values(), strict=True)])
