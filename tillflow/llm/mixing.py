"""Mixing to target weights with soft membership of domains.

A linear classifier fitted on the labelled table gives each document its probabilities of
the domains (``low``: quality 0; ``toxic``: toxic 1; ``clean``: neither).  Each document
gets a rate, its expected number of copies.  The rates solve a least-squares problem under
0 <= rate <= max_rate: the expected tokens of each domain, the sum over documents of
rate * tokens * probability, shall match the targets, with a small pull towards rate 1.

The solution has the form rate = 1 - the sum over domains of probability * pressure, cut to
its bounds, so only the pressures are looked for, by Newton steps on the dual problem.  A
round is one distributed aggregate; only its few sums come to the driver.  Rounds go on
until the optimality conditions hold to ``TOLERANCE``; after ``ROUNDS`` without that an
error is raised.  Where bounds and pull leave a target unmet by over ``UNMET``, the log says so.

Defined results: a null text has no tokens; its rate follows from its probabilities like
any other.  Without labelled rows all domains are equally likely.  A target of a domain
without tokens can't be met and is left out.  Repeated rows are mixed each.  An empty table
gives an empty result.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm import linear
from tillflow.llm.common import col, fresh, total

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.90, "low": 0.07, "toxic": 0.03}
PULL = 1e-3
TOLERANCE, ROUNDS, UNMET = 1e-8, 100, 0.005
#: Plain projected-gradient steps that come to the same rates, for comparisons.
STEPS = 20_000
_LOG = logging.getLogger(__name__)


def domain_label() -> Column:
    known = F.col("quality").isNotNull() & F.col("toxic").isNotNull()
    which = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).otherwise(0)
    return F.when(known, F.array(which.cast("int")))


def posteriors(docs: DataFrame, labels: DataFrame, carry: list[str], doc_id: str, text: str) -> DataFrame:
    """``carry``, n_words, p (probabilities in the order of DOMAINS), written to shared files."""
    data = linear.sample(docs, labels, domain_label(), doc_id, text)
    n = len(DOMAINS)
    model = linear.fit(data, data.labels[:, 0], n) if len(data.labels) else None

    def score(at, value, row, rows):  # noqa: ANN001, ANN202
        if model is None:
            return np.full((rows, n), 1 / n)
        return linear.softmax(model.scores(at, value, row, rows, np.zeros((rows, 0))))

    wanted = np.zeros(0, np.int64) if model is None else model.buckets
    return linear.scored(docs, carry, text, n, wanted, score, "mixing-domains")


def with_rates(found: DataFrame, targets: dict[str, float], max_rate: float | None = None,
               anchor: str | None = None, held: Column | None = None) -> DataFrame:
    """``found`` (n_words, p) with the column rate; rows that are ``held`` have rate 1.

    The mix shall have as many tokens as all documents, or, with an ``anchor``, as many as
    make that domain's target equal to the tokens it has.
    """
    n = len(DOMAINS)
    tokens = F.col("n_words").cast("double")
    sums = lambda weight: [
        F.coalesce(F.sum(weight * F.get("p", k)), F.lit(0.0)) for k in range(n)
    ]
    have = np.array(found.agg(*sums(tokens)).first(), float)
    size = have.sum()
    if not size:
        return found.withColumn("rate", F.lit(1.0))
    share = have / size
    want = np.array([targets.get(d, 0.0) for d in DOMAINS])
    want = want / want.sum()
    if anchor is not None:
        k = DOMAINS.index(anchor)
        want = want * share[k] / want[k]
    on = np.flatnonzero(share > 0)

    def weighed(pressure: np.ndarray):  # noqa: ANN202
        """The dual objective, its gradient, its curvature and the tokens of each domain."""
        force, rate, free = _rate(pressure, max_rate, held)
        rows = found.select(tokens.alias("w"), "p", force.alias("t"), rate.alias("r"), free.alias("free"))
        pairs = [(j, k) for j in range(n) for k in range(j, n)]
        w, r, t = F.col("w"), F.col("r"), F.col("t")
        out = np.array(rows.agg(
            F.coalesce(F.sum(w * (r * t + (r - 1) * (r - 1) / 2)), F.lit(0.0)),
            *sums(w * r),
            *[F.coalesce(F.sum(F.when(F.col("free"), w * F.get("p", j) * F.get("p", k))), F.lit(0.0))
              for j, k in pairs],
        ).first(), float) / size
        now, bent = out[1 : n + 1], np.diag(PULL * share)
        for (j, k), x in zip(pairs, out[n + 1 :]):
            bent[j, k] += x
            if j != k:
                bent[k, j] += x
        height = out[0] - want[on] @ pressure[on] - PULL / 2 * (share @ pressure**2)
        return height, (now - want - PULL * share * pressure)[on], bent[np.ix_(on, on)], now

    pressure = np.zeros(n)
    height, slope, bent, now = weighed(pressure)
    part = 1.0
    for _ in range(ROUNDS):
        if np.abs(slope / share[on]).max() < TOLERANCE:
            break
        way = np.zeros(n)
        way[on] = np.linalg.solve(bent, slope)
        tried = weighed(pressure + part * way)
        rise = 1e-4 * part * (slope @ way[on]) - 1e-13 * (1 + abs(height))
        if tried[0] >= height + rise:
            pressure = pressure + part * way
            height, slope, bent, now = tried
            part = 1.0
        else:
            part /= 2
    else:
        raise RuntimeError(f"rates not settled after {ROUNDS} rounds: {np.abs(slope / share[on]).max():.3g} left")
    if np.abs(now - want)[on].max() > UNMET:
        _LOG.warning("targets can't be met within the bounds of rates: wanted %s, got %s", want.tolist(), now.tolist())
    return found.withColumn("rate", _rate(pressure, max_rate, held)[1])


def _rate(pressure: np.ndarray, max_rate: float | None, held: Column | None) -> tuple[Column, Column, Column]:
    """What pushes a rate down, the rate, and whether it is within its bounds."""
    force = total([F.get("p", k) * F.lit(float(x)) for k, x in enumerate(pressure)])
    rate, free = F.greatest(F.lit(0.0), 1 - force), force < 1
    if max_rate is not None:
        rate, free = F.least(F.lit(float(max_rate)), rate), free & (1 - force < F.lit(float(max_rate)))
    if held is not None:
        rate, free = F.when(held, 1.0).otherwise(rate), free & ~held
    return force, rate, free


def copies(rate: Column, *key: Column) -> Column:
    """The rate as a whole number; what is left over decides by a hash of ``key``."""
    spare = F.pmod(F.xxhash64(F.lit("copies"), *key), F.lit(1_000_003)) / 1_000_003
    return (F.floor(rate) + (spare < rate - F.floor(rate)).cast("int")).cast("int")


def assigned(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens (words), p_<domain>, rate, copies for each row."""
    (key,) = fresh(docs, "mix_id")
    plain = docs.select(col(doc_id).alias(key), col(text).alias("text"))
    found = posteriors(plain, labels, [key], key, "text")
    rated = with_rates(found, targets or TARGETS)
    return rated.select(
        F.col(key).alias("doc_id"),
        F.col("n_words").alias("n_tokens"),
        *[F.get("p", k).alias(f"p_{d}") for k, d in enumerate(DOMAINS)],
        "rate",
        copies(F.col("rate"), F.col(key)).alias("copies"),
    )


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` thinned out to the targets; no row comes twice and the clean domain stays.

    A document stays when ``clean`` is its likeliest domain or its label; only the others'
    rates are moved to meet the targets.
    """
    plain = docs.select(*[col(c).alias(f"d{k}") for k, c in enumerate(docs.columns)])
    at = {c: f"d{k}" for k, c in enumerate(docs.columns)}
    found = posteriors(plain, labels, list(at.values()), at[doc_id], at[text])
    clean = DOMAINS.index("clean")
    likely = F.get("p", clean) >= F.array_max("p")
    rated = with_rates(found, targets or TARGETS, max_rate=1.0, anchor="clean", held=likely)
    drawn = copies(F.col("rate"), F.col(at[doc_id]), F.xxhash64(at[text])) > 0
    known = labels.where(F.get(domain_label(), 0) == clean).select(col("doc_id").alias("known_id"))
    names = list(at.values())
    saved = rated.where(~drawn).select(names).join(known, F.col(at[doc_id]) == F.col("known_id"), "left_semi")
    kept = rated.where(drawn).select(names).unionByName(saved)
    return kept.select(*[F.col(v).alias(c) for c, v in at.items()])
