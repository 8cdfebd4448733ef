"""Soft-membership mixing: documents' rates for target domain weights.

A naive Bayes classifier, trained on a labelled table (text, domain), gives
each document a posterior over the domains. Nonnegative rates, one for each
document, are then fitted by projected Newton steps on the least squares
of the expected token totals: sum over documents of rate * tokens * posterior
against each domain's target. A step takes one aggregation over the table of
tokens and posteriors and brings a few numbers for each pair of domains to the
driver; the rate of a document follows from its posterior and one pull for each
domain, so nothing is joined back. The fit runs until the targets are met; a
target that cannot be met is reported as a warning. Only DataFrame functions
run, no Python on the executors.

The features are the presence of words that mark a domain: for each domain the
``WORDS`` words whose share of its labelled documents exceeds that in every
other domain by most.

Defined cases: a null text counts as empty, an empty text has no tokens, the
prior as posterior and a rate like any other; an empty table gives an empty
result; without labelled rows the posterior is uniform; labelled rows without
a text or with a domain that has no target are left out; a domain in which no
document has a share cannot reach its target, the fit ends when it no longer
improves and warns; repeated rows get the same rate; helper columns carry the prefix
``_mix_``, so other names never clash.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import cut

#: Labelled rows the classifier is fitted on, at most: those with the smallest hashes of the id.
MAX_LABELS = 20_000
WORDS, TEMPER = 64, 0.25
CLOSE, WEIGHT, PACES = 1e-4, 1e8, (1.0, 0.5, 0.1, 0.01, 1e-4)

#: Target weights of the registered query and the pipeline.
TARGETS = {"en": 0.50, "de": 0.20, "fr": 0.18, "es": 0.12}

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE)


def _n_words(words: Column) -> Column:
    empty = (F.element_at(words, 1) == "").cast("int") + (F.element_at(words, -1) == "").cast("int")
    return F.when((F.size(words) == 1) & (F.element_at(words, 1) == ""), 0).otherwise(F.size(words) - empty).cast("long")


def _with_hits(docs: DataFrame, lists: list[list[str]], text_col: str) -> DataFrame:
    """``docs`` with _mix_n (words) and _mix_hits: for each list, how many of
    its words occur. Each step has a column of its own, so the text is split
    and looked up once."""
    every = [w for some in lists for w in some]

    def held(some: list[str]) -> Column:
        return F.size(F.array_intersect("_mix_found", F.array(*map(F.lit, some)))) if some else F.lit(0)

    found = F.array_intersect("_mix_words", F.array(*map(F.lit, every))) if every else F.array().cast("array<string>")
    return (docs.withColumn("_mix_words", _words(F.col(text_col)))
            .withColumns({"_mix_n": _n_words(F.col("_mix_words")), "_mix_found": found}).drop("_mix_words")
            .withColumn("_mix_hits", F.array(*map(held, lists)).cast("array<double>")).drop("_mix_found"))


class Classifier:
    """Marking words of each domain, and log-probabilities of their lists."""

    def __init__(self, domains: list[str], lists: list[list[str]], prior: np.ndarray, chance: np.ndarray):
        self.domains, self.lists, self.prior, self.chance = domains, lists, prior, chance

    def posterior(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with _mix_n and _mix_post, array<double> in the domains' order."""
        found = F.col("_mix_hits")
        logs = F.array(*[
            sum((F.element_at(found, j + 1) * F.lit(float(TEMPER * self.chance[k, j])) for j in range(len(self.lists))),
                F.lit(float(self.prior[k]))) for k in range(len(self.domains))])
        return (_with_hits(docs, self.lists, text_col).withColumn("_mix_logs", logs).drop("_mix_hits")
                .withColumn("_mix_most", F.array_max("_mix_logs"))
                .withColumn("_mix_logs", F.transform("_mix_logs", lambda v: F.exp(v - F.col("_mix_most"))))
                .withColumn("_mix_most", F.aggregate("_mix_logs", F.lit(0.0), lambda a, b: a + b))
                .withColumn("_mix_post", F.transform("_mix_logs", lambda v: v / F.col("_mix_most")))
                .drop("_mix_logs", "_mix_most"))


def train(labelled: DataFrame, domains: list[str], text_col: str = "text", domain_col: str = "domain") -> Classifier:
    """Naive Bayes from a labelled table of bounded size (see sample_ids)."""
    rows = (labelled.select(F.col(text_col).alias("text"), F.col(domain_col).cast("string").alias("domain"))
            .where(F.col("text").isNotNull() & F.col("domain").isin(domains)))
    few = cut(rows, "mix-labelled")
    sizes = {r["domain"]: r["count"] for r in few.groupBy("domain").count().collect()}
    total = np.array([sizes.get(d, 0) for d in domains], float)
    prior = np.log((total + 1) / (total.sum() + len(domains)))
    share = {d: F.sum((F.col("domain") == d).cast("int")) / F.lit(float(max(1, sizes.get(d, 0)))) for d in domains}
    words = (few.select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).where("word <> ''")
             .groupBy("word").agg(*[share[d].alias(f"s{i}") for i, d in enumerate(domains)]))
    lists = []
    for i in range(len(domains)):
        others = [F.col(f"s{j}") for j in range(len(domains)) if j != i] or [F.lit(0.0)]
        lead = F.col(f"s{i}") - F.greatest(*others, F.lit(0.0))
        best = words.withColumn("lead", lead).where("lead > 0.02").orderBy(F.desc("lead"), "word").limit(WORDS)
        lists.append([r["word"] for r in best.select("word").collect()])
    hits = [F.element_at("_mix_hits", j + 1) for j in range(len(lists))]
    sums = _with_hits(few, lists, "text").groupBy("domain").agg(
        *[F.sum(h).alias(f"h{j}") for j, h in enumerate(hits)]).collect()
    seen = {r["domain"]: [r[f"h{j}"] for j in range(len(lists))] for r in sums}
    chance = np.array([seen.get(d, [0] * len(lists)) for d in domains], float) + 1
    return Classifier(domains, lists, prior, np.log(chance / chance.sum(axis=1, keepdims=True)))


def _rate(post: Column, pull: np.ndarray) -> Column:
    """One and the domains' pulls by the posterior, projected to nonnegative rates."""
    parts = (F.element_at(post, i + 1) * F.lit(float(x)) for i, x in enumerate(pull))
    return F.greatest(F.lit(0.0), sum(parts, F.lit(1.0)))


def fit_rates(table: DataFrame, shares: np.ndarray, total: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(n, post) -> the domains' pulls, and what the domains' totals came to
    relative to their targets. Without ``total``, the smallest at which no
    domain is cut.

    The rates minimise half the sum of n * (rate - 1)^2 and of ``WEIGHT`` times
    the tokens times the squared residuals, which are relative to the targets.
    Its dual in the pulls is convex and piecewise quadratic: a Newton step takes
    the curvature of the documents whose rate is not zero, and the best of
    ``PACES`` of it, all found in one aggregation. The fit ends when the
    residual is below ``CLOSE`` or the dual no longer falls.
    """
    k = len(shares)
    p = [F.element_at("post", i + 1) for i in range(k)]
    n = F.col("n")
    have = np.array([x or 0.0 for x in table.agg(*[F.sum(n * x).alias(f"a{i}") for i, x in enumerate(p)]).first()], float)
    if have.sum() == 0:
        return np.zeros(k), np.zeros(k)
    if total is None:
        total = float(max(h / s for h, s in zip(have, shares, strict=True) if s > 0))
    goal = np.maximum(shares * total, 1e-9)
    soft = goal**2 / (WEIGHT * have.sum())
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def look(pulls: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """The dual, the totals and the curvature at each of the pulls."""
        rates = [f"rate{c}" for c in range(len(pulls))]
        sums = []
        for r in map(F.col, rates):
            some = F.when(r > 0, n).otherwise(F.lit(0))
            sums += [F.sum(n * r * r), *[F.sum(n * r * x) for x in p], *[F.sum(some * p[i] * p[j]) for i, j in pairs]]
        rated = table.withColumns({r: _rate(F.col("post"), x) for r, x in zip(rates, pulls, strict=True)})
        row = rated.agg(*[x.alias(f"x{i}") for i, x in enumerate(sums)]).first()
        out = []
        for x, got in zip(pulls, np.array(row, float).reshape(len(pulls), -1), strict=True):
            curve = np.zeros((k, k))
            for (i, j), v in zip(pairs, got[1 + k :], strict=True):
                curve[i, j] = curve[j, i] = v
            out.append((got[0] / 2 - float(goal @ x) + float(soft @ x**2) / 2, got[1 : 1 + k], curve))
        return out

    pull = np.zeros(k)
    dual, got, curve = look([pull])[0]
    while np.abs(got / goal - 1).max() >= CLOSE:
        slope = (got - goal + soft * pull) / goal
        step = np.linalg.lstsq(curve / np.outer(goal, goal) + np.diag(soft / goal**2), -slope, rcond=None)[0] / goal
        tried = [pull + pace * step for pace in PACES]
        at, (low, *rest) = min(zip(tried, look(tried), strict=True), key=lambda t: t[1][0])
        if not low < dual - 1e-13 * abs(dual):
            break
        pull, dual, (got, curve) = at, low, rest
    return pull, got / goal


def mix(docs: DataFrame, classifier: Classifier, targets: dict[str, float], total: float | None = None,
        text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all) of ``docs`` with _mix_n (tokens), _mix_post,
    _mix_rate and _mix_copies: the rate rounded up or down by a hash of the
    text, right on average. The columns are written once with the posteriors;
    the fit reads only those, and the rates are a narrow pass over the rest."""
    weights = np.array([targets[d] for d in classifier.domains], float)
    by_hash = F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    known = classifier.posterior(docs.withColumn("_mix_u", by_hash), text_col)
    carry = docs.columns if carry is None else carry
    table = cut(known.select(*[F.col(f"`{c}`") for c in carry], "_mix_u", "_mix_n", "_mix_post"), "mix-posteriors")
    pull, came = fit_rates(table.select(F.col("_mix_n").alias("n"), F.col("_mix_post").alias("post")),
                           weights / weights.sum(), total)
    if came.any() and np.abs(came - 1).max() >= CLOSE:
        missed = ", ".join(f"{d}: {x:.4f}" for d, x in zip(classifier.domains, came, strict=True))
        warnings.warn(f"mixing targets not met; totals relative to their targets: {missed}", stacklevel=2)
    rated = table.withColumn("_mix_rate", _rate(F.col("_mix_post"), pull))
    return rated.withColumn("_mix_copies", F.floor(F.col("_mix_rate") + F.col("_mix_u")).cast("int")).drop("_mix_u")


def sample_ids(labels: DataFrame, most: int = MAX_LABELS) -> DataFrame:
    return (labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))


def labelled_by_language(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the registered query: a bounded number of rows of
    ``labels``, one for an id, with the language that the documents table
    states for them as the domain."""
    rows = docs.join(F.broadcast(sample_ids(labels)), "doc_id").select("doc_id", "text", F.col("lang").alias("domain"))
    return rows.groupBy("doc_id").agg(F.min(F.struct("text", "domain")).alias("r")).select("r.text", "r.domain")


def op5_mixing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    classifier = train(labelled_by_language(docs, labels), list(TARGETS))
    posts = [F.element_at("_mix_post", i + 1).alias(f"p_{d}") for i, d in enumerate(classifier.domains)]
    return mix(docs, classifier, TARGETS, carry=["doc_id"]).select(
        "doc_id", F.col("_mix_n").alias("n_tokens"), *posts, F.col("_mix_rate").alias("rate"),
        F.col("_mix_copies").alias("copies"))
