"""Mixing to target weights with soft membership.

A classifier trained on a labelled table gives each document a posterior over domains.
Every document gets a nonnegative rate, the expected number of its copies in the mix,
so that the expected tokens per domain, the sum of rate x tokens x posterior, match the
targets. That is a least-squares problem with one unknown per document and one equation
per domain. Projected gradient solves it: a round sums the domains' totals over all
documents, and each document then moves against the gradient, taken ahead of the last
step to converge faster, and stops at zero.

Rates live in the table; only a few numbers per domain reach the driver. Gradients are
taken in the metric of the domains' second moments, in which a full step is safe and
correlated domains do not slow the rounds down.
"""

from __future__ import annotations

import logging
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatide.llm.decontaminate import token_parts
from verbatide.llm.sampling import first_of_groups
from verbatide.storage import cut_lineage

LOG = logging.getLogger(__name__)
FEATURES = 1 << 15
# At most so many labelled documents of a domain train the classifier.
TRAIN_PER_DOMAIN = 1500
STEPS, BATCH, RATE, DECAY, SEED = 1000, 64, 0.05, 1e-5, 11
# Of the wanted tokens; and the rounds after which a fit that creeps is ended, with a warning.
TOLERANCE, MOST_ROUNDS = 1e-6, 60
# Lengths of step that a round tries.
LENGTHS = tuple(4.0**i for i in range(-3, 9))
# Rows that a task of a round reads, where there are more than tasks that run at once; and
# the numbers that it holds for as many rows as it works on at once.
TASK_ROWS, CELLS = 1 << 18, 1 << 18


def _features(symbols: np.ndarray):
    """(hashed words, weights): logarithmic counts, scaled to length one."""
    ids, counts = np.unique(symbols % np.uint64(FEATURES), return_counts=True)
    weights = np.log1p(counts)
    return ids.astype(np.int64), weights / max(np.sqrt((weights * weights).sum()), 1e-12)


class Classifier:
    def __init__(self, domains):
        self.domains = list(domains)
        self.weights = np.zeros((FEATURES, len(self.domains)))
        self.bias = np.zeros(len(self.domains))

    def posterior(self, ids, weights) -> np.ndarray:
        logits = weights @ self.weights[ids] + self.bias
        e = np.exp(logits - logits.max())
        return e / e.sum()

    def fit(self, rows: list, target: np.ndarray):
        """Softmax regression by Adam, over STEPS batches."""
        draw = np.random.default_rng(SEED)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in (self.weights, self.bias)]
        for step in range(1, STEPS + 1 if rows else 1):
            some = draw.integers(0, len(rows), BATCH)
            grad, base = DECAY * self.weights, np.zeros_like(self.bias)
            for i in some:
                ids, weights = rows[i]
                error = self.posterior(ids, weights)
                error[target[i]] -= 1
                grad[ids] += weights[:, None] * error / BATCH
                base += error / BATCH
            for p, g, (m, v) in zip((self.weights, self.bias), (grad, base), state):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self


def train_classifier(docs: DataFrame, labels: DataFrame, domains) -> Classifier:
    """Learn from ``labels`` (doc_id, domain), of which rows with a domain outside
    ``domains`` or a null are left out, and a doc_id's least domain counts. At most
    TRAIN_PER_DOMAIN documents of each domain, drawn by hash, are read."""
    spark = docs.sparkSession
    one_each = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "domain")
        .filter(F.col("doc_id").isNotNull() & F.col("domain").isin(*domains))
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    chosen = first_of_groups(one_each, "domain", "order", TRAIN_PER_DOMAIN)
    # Read first, so that what is broadcast has the size the number above allows.
    picked = chosen.select("doc_id", "domain").toPandas()
    few = spark.createDataFrame(picked, "doc_id long, domain string")

    def read(batches):
        for part, symbols, at in chain.from_iterable(map(token_parts, batches)):
            rows = [_features(symbols[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch(
                [
                    part.column("doc_id"),
                    part.column("domain"),
                    pa.array([r[0].tolist() for r in rows], pa.list_(pa.int64())),
                    pa.array([r[1].tolist() for r in rows], pa.list_(pa.float64())),
                ],
                names=["doc_id", "domain", "ids", "weights"],
            )

    examples = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(few), "doc_id")
        # Repeated rows of a document are one example: the least text that is not null.
        .groupBy("doc_id", "domain")
        .agg(F.min("text").alias("text"))
        .mapInArrow(read, "doc_id long, domain string, ids array<long>, weights array<double>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("domain", "ascending")])
    )
    rows = [
        (np.array(i, np.int64), np.array(w))
        for i, w in zip(examples.column("ids").to_pylist(), examples.column("weights").to_pylist())
    ]
    target = np.array([list(domains).index(d) for d in examples.column("domain").to_pylist()], int)
    return Classifier(domains).fit(rows, target)


def domain_posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(place, doc_id, n_tokens, posterior) for every row; tokens are words. A text
    without words has the posterior that the bias gives. ``place`` tells rows apart."""

    def read(batches):
        for part, symbols, at in chain.from_iterable(map(token_parts, batches)):
            rows = [
                classifier.posterior(*_features(symbols[a:b])).tolist()
                for a, b in zip(at[:-1], at[1:])
            ]
            yield pa.record_batch(
                [
                    part.column("place"),
                    part.column("doc_id"),
                    pa.array(np.diff(at)),
                    pa.array(rows, pa.list_(pa.float64())),
                ],
                names=["place", "doc_id", "n_tokens", "posterior"],
            )

    return docs.select(
        F.monotonically_increasing_id().alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    ).mapInArrow(read, "place long, doc_id long, n_tokens long, posterior array<double>")


def _replayed(start: float, steps: list):
    """A function from posteriors (rows, domains) to the rates after all steps."""

    def rates(posterior: np.ndarray):
        rate = np.full(len(posterior), start)
        for step in steps:
            rate = np.maximum(rate - posterior @ step, 0.0)
        return rate

    return rates


def _blocks(batch, k):
    """(tokens, posteriors) of a batch's rows."""
    return (
        batch.column("n_tokens").to_numpy().astype(float),
        batch.column("posterior").flatten().to_numpy().reshape(-1, k),
    )


def _packed(members: DataFrame, k: int, number: int) -> DataFrame:
    """(tokens, posteriors): the numbers of many rows in one, as doubles, stored, and read
    by as many tasks as ``number`` rows need."""

    def pack(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens, posterior = _blocks(batch, k)
            yield pa.record_batch(
                [pa.array([x.tobytes()], pa.binary()) for x in (tokens, posterior)],
                names=["tokens", "posteriors"],
            )

    rows = members.select("n_tokens", "posterior").mapInArrow(pack, "tokens binary, posteriors binary")
    tasks = max(members.sparkSession.sparkContext.defaultParallelism, -(-number // TASK_ROWS))
    return cut_lineage(rows).coalesce(tasks)


def _unpacked(batches, k, most):
    """(tokens, posteriors) of up to ``most`` rows at a time."""
    for batch in batches:
        for tokens, posterior in zip(batch.column("tokens"), batch.column("posteriors")):
            tokens = np.frombuffer(tokens.as_buffer(), float)
            posterior = np.frombuffer(posterior.as_buffer(), float).reshape(-1, k)
            for at in range(0, len(tokens), most):
                yield tokens[at : at + most], posterior[at : at + most]


def fit_rates(members: DataFrame, targets: list[float]) -> DataFrame:
    """``members`` (n_tokens, posterior, ...) with the column ``rate``.

    ``targets`` are the wanted tokens per domain. The rates are nonnegative and minimise
    the squared distance of the domains' expected totals from the targets: these are met
    if they can be, to TOLERANCE of all tokens. Rates start alike, with the wanted total.

    Each round is a projected step along the rows' gradients, which all follow from one
    vector of the domains: as it is, or scaled by the moments of all rows or of those
    whose rate is above zero. One pass adds up totals and moments for several lengths of
    each, and the best is taken; rows replay the steps so far, so no state is stored
    between rounds, which read the rows' numbers from a packed copy. Among the steps is
    one that is short enough to bring a gain wherever there is one, so a round that
    brings next to none ends the fit at the optimum; as a last resort MOST_ROUNDS does.
    What was reached is logged, as a warning if it differs.
    A table without tokens, or without rows, has rate 0 for all rows.
    """
    k = len(targets)
    wanted = np.array(targets, float)
    members = members.withColumn("posterior", F.col("posterior").cast("array<double>"))

    def survey(start, steps, trials):
        """(totals, moments of rows above zero, moments of all) after each trial step."""
        rates, width, tried = _replayed(start, steps), k + k * k, np.array(trials).T

        def add_up(batches):
            sums, both = np.zeros((len(trials), width)), np.zeros(k * k)
            for tokens, posterior in _unpacked(batches, k, max(1, CELLS // (k * k + len(trials)))):
                weighted = posterior * tokens[:, None]
                moments = (weighted[:, :, None] * posterior[:, None, :]).reshape(-1, k * k)
                both += moments.sum(axis=0)
                # A row for each row here, a column for each trial.
                rate = np.maximum(rates(posterior)[:, None] - posterior @ tried, 0.0)
                sums[:, :k] += rate.T @ weighted
                sums[:, k:] += (rate > 0).T.astype(float) @ moments
            flat = np.append(sums.ravel(), both).tolist()
            yield pa.record_batch([pa.array([flat], pa.list_(pa.float64()))], names=["sums"])

        # One row for each task, of a size that the domains alone fix.
        parts = packed.mapInArrow(add_up, "sums array<double>").toArrow().column(0).combine_chunks()
        found = parts.flatten().to_numpy().reshape(-1, len(trials) * width + k * k).sum(axis=0)
        shaped = found[: -k * k].reshape(len(trials), width)
        return shaped[:, :k], shaped[:, k:].reshape(-1, k, k), found[-k * k :].reshape(k, k)

    whole, number = members.agg(F.sum(F.col("n_tokens").cast("double")), F.count("*")).first()
    if not whole:
        return members.withColumn("rate", F.lit(0.0))
    packed = _packed(members, k, number)
    start, steps, rounds = wanted.sum() / whole, [], 0
    allowed = TOLERANCE * wanted.sum()
    (reached,), (active,), moments = survey(start, steps, [np.zeros(k)])
    safe = 1 / max(np.linalg.eigvalsh(moments).max(), 1e-300)
    invert = lambda m: np.linalg.pinv(m, rcond=1e-10, hermitian=True)
    while np.abs(reached - wanted).max() > allowed and rounds < MOST_ROUNDS:
        rounds += 1
        gap = reached - wanted
        ways = (gap * safe, invert(moments) @ gap, invert(active) @ gap)
        trials = [way * length for way in ways for length in LENGTHS]
        totals, actives, _ = survey(start, steps, trials)
        best = int(((totals - wanted) ** 2).sum(axis=1).argmin())
        nearer = np.sqrt((gap**2).sum()) - np.sqrt(((totals[best] - wanted) ** 2).sum())
        if nearer <= 0.01 * allowed:
            break
        steps, reached, active = [*steps, trials[best]], totals[best], actives[best]
    level = logging.INFO if np.abs(reached - wanted).max() <= allowed else logging.WARNING
    LOG.log(
        level, "rates after %d rounds: totals %s, targets %s", rounds, reached.tolist(), wanted.tolist()
    )
    rates = _replayed(start, steps)
    names = members.columns

    def rated(batches):
        for batch in batches:
            rate = rates(_blocks(batch, k)[1])
            yield pa.record_batch([*batch.columns, pa.array(rate)], names=[*names, "rate"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in members.dtypes)
    return members.mapInArrow(rated, f"{kinds}, rate double")


def domain_totals(mixed: DataFrame, weights: dict[str, float], budget: float = 1.0) -> DataFrame:
    """(domain, target, reached): expected tokens of each domain in what ``mix`` returns,
    beside those that were asked for. One row for each domain, also of an empty table."""
    domains = sorted(weights)
    tokens = F.col("n_tokens").cast("double")
    share = [F.sum(tokens * F.col("rate") * F.col("posterior")[i]) for i in range(len(domains))]
    total = mixed.agg(F.sum(tokens).alias("tokens"), F.array(*share).alias("reached"))
    parts = [weights[d] / sum(weights.values()) * budget for d in domains]
    return total.select(
        "tokens",
        F.posexplode("reached").alias("i", "reached"),
    ).select(
        F.array(*map(F.lit, domains))[F.col("i")].alias("domain"),
        (F.coalesce("tokens", F.lit(0.0)) * F.array(*map(F.lit, parts))[F.col("i")]).alias("target"),
        F.coalesce("reached", F.lit(0.0)).alias("reached"),
    )


def mix(
    docs: DataFrame, labels: DataFrame, weights: dict[str, float], budget: float = 1.0
) -> DataFrame:
    """(doc_id, n_tokens, posterior, rate, copies) for every row of ``docs``.

    ``weights`` are the domains' target shares; the mix's expected tokens are
    ``budget`` times those of ``docs``. ``copies`` is the rate rounded up or down with
    the rate's fraction as chance, drawn by a hash of the doc_id and the row's length,
    so that runs repeat. Null and empty texts have no tokens; repeated rows count each;
    a missing doc_id is as good as any.
    """
    domains = sorted(weights)
    classifier = train_classifier(docs, labels, domains)
    members = cut_lineage(domain_posteriors(docs, classifier))
    whole = members.agg(F.sum("n_tokens")).first()[0] or 0
    scale = whole * budget / sum(weights.values())
    rated = fit_rates(members, [weights[d] * scale for d in domains])
    chance = F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(1 << 40)) / float(1 << 40)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    return rated.select("place", "doc_id", "n_tokens", "posterior", "rate", copies.alias("copies"))
