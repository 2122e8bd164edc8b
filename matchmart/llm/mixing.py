"""Soft-membership mixing to target weights (operator 1).

A classifier learned from the table of labels gives every document a posterior
over domains; document rates r >= 0 are then fitted so that the expected tokens
of each domain, sum of r * tokens * posterior, meet the targets:

    1/2 sum_k (share_k - target_k)^2 / base_k + ridge/2 sum_d w_d (r_d - 1)^2

with w_d the document's part of all tokens. Projected gradient descent with
the step 1 / (1 + ridge) solves it: in the metric of w the gradient at a
document is sum_k p_dk (share_k - target_k) / base_k + ridge (r_d - 1), and the
first term's curvature is at most 1. A round is one aggregate over the table of
posteriors; the driver keeps a vector of one number a domain and round, from
which any task recomputes any document's rate. Built-in functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchmart.llm.common import dropped, staged, table

DOMAINS = ["low", "clean", "toxic"]
BUCKETS = 1 << 16  # hashed words
#: Labelled documents that the classifier learns from, at most: those whose id
#: hashes smallest.
TRAIN_ROWS = 20_000
#: Log prior of a domain without labelled documents: no text's words outweigh it.
ABSENT = -1e9
ROUNDS, RIDGE, TOLERANCE = 40, 1e-3, 1e-7

#: Default weights of the mix.
TARGETS = {"low": 0.02, "clean": 0.95, "toxic": 0.03}


def tokens(text: Column) -> Column:
    """The words of a text: runs between ASCII controls, spaces and . , ! ?"""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x20.,!?]+"), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def label_domain() -> Column:
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1).when(F.col("quality") == 0, 0)


@dataclass(frozen=True)
class Model:
    """Of each domain the log prior and BUCKETS log weights: a size that does
    not depend on the corpus. ``learned``: some labelled document had words."""

    priors: list[float]
    weights: list[list[float]]
    learned: bool


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Naive Bayes over hashed words (counts plus one half), by domain.

    Learns from at most ``rows`` labelled documents, a bounded broadcast. Of
    labels that repeat a document the worst counts; labels without a domain or
    an id are left out; a domain without labelled documents has a posterior of
    0. Without any labels all domains weigh the same.
    """
    known = (
        labels.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .select("doc_id", label_domain().alias("domain"))
        .where("domain IS NOT NULL AND doc_id IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    counts = (
        chosen.select("domain", F.explode(tokens(F.col("text"))).alias("word"))
        .groupBy(bucket(F.col("word")).alias("bucket"), "domain")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ks = range(len(DOMAINS))
    sums = [F.sum(F.when(F.col("domain") == k, F.col("n"))).alias(f"n{k}") for k in ks]
    weights = [[0.5] * BUCKETS for _ in ks]
    found = counts.groupBy("bucket").agg(*sums).collect()  # BUCKETS rows at most
    for row in found:
        for k in ks:
            weights[k][row["bucket"]] += row[f"n{k}"] or 0
    logs = [[round(math.log(n / total), 3) for n in w] for w in weights for total in [sum(w)]]
    seen = {r["domain"]: r["n"] for r in known.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    priors = [math.log(seen[k] + 1e-3) if seen.get(k) else ABSENT for k in ks]
    return Model(priors, logs, bool(found))


def posteriors(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry`` columns, then n_tokens and one posterior p_<domain> a domain.
    A null or empty text has no tokens and gets the priors."""
    hashed = F.transform(tokens(F.col("text")), bucket)
    rows = docs.select(*[F.col(f"`{c}`") for c in carry], hashed.alias("__b"))

    def score(k: int) -> Column:
        # One string is quick to send; the plan folds the cast to an array literal.
        weights = F.split(F.lit(",".join(map(str, model.weights[k]))), ",").cast("array<float>")
        return F.aggregate("__b", F.lit(float(model.priors[k])), lambda a, b: a + F.get(weights, b))

    scores = [score(k) for k in range(len(DOMAINS))]
    rows = rows.select(
        *[F.col(f"`{c}`") for c in carry],
        F.size("__b").cast("long").alias("n_tokens"),
        F.array(*scores).alias("__s"),
    )
    top = F.array_max("__s")
    rows = rows.withColumn("__e", F.transform("__s", lambda s: F.exp(s - top)))
    total = F.aggregate("__e", F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *[F.col(f"`{c}`") for c in carry],
        "n_tokens",
        *[(F.get("__e", F.lit(k)) / total).alias(f"p_{d}") for k, d in enumerate(DOMAINS)],
    )


def rate(history: list[list[float]], upper: float | None) -> Column:
    """A document's rate after the gradient steps whose domain terms are given."""
    cap = lambda r: F.greatest(F.lit(0.0), r if upper is None else F.least(r, F.lit(float(upper))))
    if not history:
        return cap(F.lit(1.0))
    # The posteriors ride in the accumulator, so a step never computes them again.
    start = F.struct(cap(F.lit(1.0)).alias("r"), F.array(*[F.col(f"p_{d}") for d in DOMAINS]).alias("p"))

    def step(now: Column, terms: Column) -> Column:
        pull = F.lit(0.0)
        for k in range(len(DOMAINS)):
            pull = pull + now["p"][k] * terms[k]
        r = cap(now["r"] - (pull + RIDGE * (now["r"] - 1.0)) / (1.0 + RIDGE))
        return F.struct(r.alias("r"), now["p"].alias("p"))

    return F.aggregate(F.lit(history), start, step, lambda now: now["r"])


def fit_rates(soft: DataFrame, targets: dict[str, float], upper: float | None = None) -> list[list[float]]:
    """The domain terms of every projected gradient step, from a (staged) table
    of n_tokens and posteriors.

    Targets are weights of the mix; a domain without one is free. The mix has
    as many tokens as the table, or, with rates bounded by ``upper``, as many as
    the bound lets the domain of the greatest weight have. Under a bound the
    other weights are ceilings: a domain too scarce for its weight is taken as
    far as the bound goes and lowers no other; the one of the greatest weight
    makes up for it as far as it can. A target for a domain without any mass
    can't be met, and is left out.
    """
    sums = lambda r: [F.sum(r * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS]
    base = soft.agg(*sums(F.lit(1.0))).first()
    total = sum(base[d] or 0.0 for d in DOMAINS)
    if not total:
        return []
    share = {d: base[d] / total for d in DOMAINS}
    goal = {d: w for d, w in targets.items() if share[d] > 1e-9}
    weight = sum(goal.values())
    if weight <= 0:
        return []
    mass = sum(share[d] for d in goal)
    main = max(goal, key=goal.get)
    if upper is not None:
        mass = min(mass, upper * share[main] * weight / goal[main])
    goal = {d: w / weight * mass for d, w in goal.items()}
    if upper is not None:
        goal = {d: min(g, upper * share[d]) for d, g in goal.items()}
        goal[main] = min(upper * share[main], mass - sum(g for d, g in goal.items() if d != main))
    history: list[list[float]] = []
    now = dict(share)
    for _ in range(ROUNDS):
        history.append([(now[d] - goal[d]) / share[d] if d in goal else 0.0 for d in DOMAINS])
        row = soft.agg(*sums(rate(history, upper))).first()
        new = {d: row[d] / total for d in DOMAINS}
        done = max(abs(new[d] - now[d]) for d in DOMAINS) < TOLERANCE
        now = new
        if done:
            break
    return history


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, upper: float | None = None) -> DataFrame:
    """One row per input row: doc_id, source, n_tokens, p_<domain>, rate.

    Reads doc_id, source and text. Null and empty texts have no tokens and a
    rate that their priors give; null ids or sources and repeated rows are rows
    like any other (a label reaches every row of its id); an empty table gives
    none.
    """
    model = train(docs, labels)
    soft = staged(posteriors(docs, model, ["doc_id", "source"]), "mix-posteriors")
    history = fit_rates(soft, targets, upper)
    return soft.withColumn("rate", rate(history, upper))


def sample(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The rows of ``docs``, with all their columns, that a mix with rates of at
    most 1 draws: a row stays where a hash of its id, spread over [0, 1), is
    below its rate. No join moves the texts: rates follow from the text and the
    fitted steps alone. Without labelled documents nothing tells domains apart,
    and all rows stay."""
    model = train(docs, labels)
    if not model.learned:
        return docs
    soft = staged(posteriors(docs, model, []), "mix-posteriors")
    history = fit_rates(soft, targets, upper=1.0)
    dropped(soft)
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select("*", F.col("text").alias("__text")).withColumnsRenamed(names)
    rows = posteriors(renamed.withColumnRenamed("__text", "text"), model, list(names.values()))
    # A filter pushed below the posteriors would compute them for each mention;
    # it stays above a row number, which it also reads.
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    chance = F.pmod(F.xxhash64(names["doc_id"], F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    kept = rows.where((chance < rate(history, 1.0)) & (F.col("__row") >= 0))
    return kept.select(*[F.col(f"`{v}`").alias(c) for c, v in names.items()])


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
