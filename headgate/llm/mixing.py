"""Mixing documents to target weights of domains they belong to softly, on DataFrame functions only.

A naive Bayes classifier over the presence of words (by 64-bit hash), learned from a labelled table, gives every document a
posterior over the domains. A nonnegative rate per document (how often it is drawn) is then fitted
by projected-gradient least squares, so that the expected tokens of each domain, the sum of rate x
tokens x posterior, meet the targets.

In the metric that weighs a document by its tokens, the gradient of a document is the domain
residuals weighted by its posterior: a few numbers that are the same for all documents. So a rate is a fold over the
residuals of all rounds so far, computed in the scan of a table of posteriors; a round is one
aggregation to one number per domain and writes nothing.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headgate.functions.names import quoted, unused
from headgate.llm.tables import kept, words

#: Labelled documents that the classifier is fitted on (those first by hash), and words it may know.
LABELLED = 20_000
WORDS = 50_000
#: Standard deviations above chance, in the domain where a word lies highest, at which it counts by half.
TELLING = 3.0
#: Occurrences by chance that are added to every word: a word of one group of near copies tells little.
PSEUDO = 20.0
ROUNDS = 40
TOLERANCE = 1e-6
#: Shares of the tokens that the production mix should have.
TARGETS = {"good": 0.9, "low": 0.09, "toxic": 0.01}


def domain_labels(labels: DataFrame) -> DataFrame:
    """`doc_id, domain` of a table of `quality` and `toxic` marks; rows without a mark have none.

    Of contradicting rows of one document the alphabetically last domain holds.
    """
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    marked = labels.select("doc_id", domain.alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL")
    return marked.groupBy("doc_id").agg(F.max("domain").alias("domain"))


def _features(documents: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, `bucket` and `n`: a row per distinct word of a text and two for its look.

    Every text has rows; `n` is its number of words in one of them and zero in the others.
    """
    texts = documents.select(*keep, F.coalesce("text", F.lit("")).alias("t")).select(*keep, "t", words(F.col("t")).alias("w"))
    texts = texts.select(*keep, F.length("t").alias("long"), F.size("w").alias("n"), F.array_distinct("w").alias("w"))
    most = F.greatest("n", F.lit(1))
    varied = F.concat(F.lit("\x01"), F.floor(10 * F.size("w") / most).cast("string"))
    spread = F.concat(F.lit("\x02"), F.least(F.floor(2 * F.col("long") / most), F.lit(40)).cast("string"))
    tokens = texts.select(*keep, "n", F.posexplode(F.concat(F.array(varied, spread), F.col("w"))).alias("at", "token"))
    bucket = F.xxhash64("token").alias("bucket")
    return tokens.select(*keep, bucket, F.when(F.col("at") == 0, F.col("n")).otherwise(0).alias("n"))


class Classifier:
    """Domains, their log prior, and a table `bucket, w0, w1, ...` of log odds of telling words; the prior has that none is there."""

    def __init__(self, domains: list[str], prior: list[float], weights: DataFrame):
        self.domains, self.prior, self.weights = domains, prior, weights


def learn(documents: DataFrame, labelled: DataFrame, domains: list[str], limit: int = LABELLED) -> Classifier:
    """Naive Bayes over the labelled documents; at most `limit` of them, chosen by hash of the id."""
    chosen = kept(labelled.where(F.col("domain").isin(domains)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit), "op5-labelled")
    # At most `limit` rows. Copies of a text teach once, or their rare words would seem to tell much.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["text"])
    texts = kept(texts.select("domain", "text"), "op5-texts")
    seen = F.struct(*[F.sum((F.col("domain") == d).cast("long")).alias(f"c{k}") for k, d in enumerate(domains)])
    counts = kept(_features(texts, ["domain"]).groupBy("bucket").agg(seen.alias("c")).select("bucket", "c.*"), "op5-counts")
    have = dict(texts.groupBy("domain").count().collect())
    sizes = [have.get(d, 0) for d in domains]
    total = max(sum(sizes), 1)
    here = sum((F.col(f"c{k}") for k in range(len(domains))), F.lit(0))
    everywhere = (here + PSEUDO) / (total + 1 + 2 * PSEUDO)
    telling, shares = F.lit(0.0), []
    for k, size in enumerate(sizes):
        count, expected, chance = F.col(f"c{k}"), here * (size / total), PSEUDO * (size + 1) / (total + 1)
        telling = F.greatest(telling, (count - expected) / F.sqrt(expected + 1.0))
        shares.append((count + chance) / (size + 1 + 2 * chance))
    # Every word tells, by its log odds against those of all domains; what may be chance shrinks them.
    sure = 1 / (1 + F.pow(TELLING / F.greatest(telling, F.lit(1e-3)), F.lit(4.0)))
    logs = [(sure * (F.log(s / (1 - s)) - F.log(everywhere / (1 - everywhere)))).alias(f"w{k}") for k, s in enumerate(shares)]
    absent = [(sure * (F.log(1 - s) - F.log(1 - everywhere))).alias(f"a{k}") for k, s in enumerate(shares)]
    known = kept(counts.select("bucket", telling.alias("telling"), *logs, *absent).orderBy(F.desc("telling"), "bucket").limit(WORDS), "op5-known")
    base = known.agg(*[F.sum(f"a{k}") for k in range(len(domains))]).first()
    logs = [f"w{k}" for k in range(len(domains))]
    if base[0] is None:
        warnings.warn("no labelled document has a text: every posterior is the prior", stacklevel=2)
    prior = [math.log((n + 1) / (total + len(domains))) + (a or 0.0) for n, a in zip(sizes, base, strict=True)]
    return Classifier(domains, prior, known.select("bucket", *logs))


def posteriors(documents: DataFrame, model: Classifier) -> DataFrame:
    """`doc_id, n_tokens, p`: words of the document, and its probability of each domain."""
    each = range(len(model.domains))
    # At most WORDS rows of a few numbers: the size of the broadcast is fixed by a parameter.
    told = _features(documents, ["doc_id"]).join(F.broadcast(model.weights), "bucket", "left")
    odds = told.groupBy("doc_id").agg(F.sum("n").alias("n_tokens"), *[F.coalesce(F.sum(f"w{k}"), F.lit(0.0)).alias(f"s{k}") for k in each])
    scores = [F.col(f"s{k}") + F.lit(model.prior[k]) for k in each]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    raised = F.array(*[F.exp(s - top) for s in scores])
    whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return odds.withColumn("e", raised).select("doc_id", "n_tokens", F.transform("e", lambda x: x / whole).alias("p"))


def _rate(steps: list[list[float]], p: Column) -> Column:
    """The rate after these steps: each moves it by the residuals in its posterior, never below zero."""
    if not steps:
        return F.lit(1.0)
    history = F.array(*[F.array(*map(F.lit, step)) for step in steps])

    def move(rate: Column, step: Column) -> Column:
        slope = sum((F.get(step, F.lit(d)) * F.get(p, F.lit(d)) for d in range(len(steps[0]))), F.lit(0.0))
        return F.greatest(F.lit(0.0), rate - slope)

    return F.aggregate(history, F.lit(1.0), move)


def fit_rates(table: DataFrame, targets: list[float], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> list[list[float]]:
    """Steps that bring the expected tokens per domain of `n_tokens, p` to the targets, or next to them."""
    each = range(len(targets))
    steps: list[list[float]] = []
    mass: list[float] = []
    scale = max(sum(targets), 1.0)
    for _ in range(rounds + 1):
        drawn = F.col("n_tokens") * _rate(steps, F.col("p"))
        now = [x or 0.0 for x in table.agg(*[F.sum(drawn * F.get("p", F.lit(d))) for d in each]).first()]
        mass = mass or [max(x, 1e-9) for x in now]
        gap = [x - t for x, t in zip(now, targets, strict=True)]
        if max(map(abs, gap)) <= tolerance * scale:
            break
        steps.append([g / m for g, m in zip(gap, mass, strict=True)])
    return steps


def mix(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, budget: float | None = None) -> DataFrame:
    """`doc_id, n_tokens, p_<domain>..., rate` for every document.

    `labelled` has `doc_id, domain`; `targets` are shares of `budget` tokens, by default as many as
    the documents have. Rows of one `doc_id` (null is one id) are one document whose words add up.
    Null and empty texts have no tokens and the posterior of an empty text; their rate draws
    nothing. Without labels every document belongs to all domains alike. A domain that no document
    belongs to cannot reach its target; the others do. An empty table gives no rows.
    """
    domains = sorted(targets)
    table = kept(posteriors(documents, learn(documents, labelled, domains)), "op5-posteriors")
    whole = budget if budget is not None else float(table.agg(F.sum("n_tokens")).first()[0] or 0)
    steps = fit_rates(table, [targets[d] * whole / max(sum(targets.values()), 1e-12) for d in domains])
    parts = [F.get("p", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(domains)]
    return table.select("doc_id", "n_tokens", *parts, _rate(steps, F.col("p")).alias("rate"))


def with_rates(documents: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The documents with their own columns and, after them, what `mix` says of them.

    A column of the documents keeps its name and value; one of `mix` that would have the same name
    is called `mixed_` and that.
    """
    own = {c.lower() for c in documents.columns}
    of = unused(documents, "_of")
    said, names = mix(documents, labelled, targets), []
    for name in said.columns[1:]:
        while name.lower() in own:
            name = f"mixed_{name}"
        names.append(name)
    said = kept(said.toDF(of, *names), "op5-rates")
    joined = documents.join(said, F.col("doc_id").eqNullSafe(F.col(of)))
    return joined.select(*map(quoted, [*documents.columns, *names]))
