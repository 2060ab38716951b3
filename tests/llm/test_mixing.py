import numpy as np
import pytest

from verbatide.llm.mixing import domain_totals, fit_rates, mix


def plain_least_squares(rows, wanted):
    """Projected gradient, one short step after another, in one place."""
    tokens, posterior = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    weighted = posterior * tokens[:, None]
    length = 1 / np.linalg.eigvalsh(posterior.T @ weighted).max()
    rate = np.full(len(rows), sum(wanted) / tokens.sum())
    for _ in range(100_000):
        rate = np.maximum(rate - posterior @ (weighted.T @ rate - wanted) * length, 0)
    return weighted.T @ rate


@pytest.mark.parametrize("spread,shares,met", [(0.3, [0.97, 0.02, 0.01], True), (5.0, [0.1, 0.1, 0.8], False)])
def test_totals_of_plain_least_squares(spark, spread, shares, met):
    draw = np.random.default_rng(4)
    posteriors = draw.dirichlet([3 * spread, spread, spread / 2], 300)
    rows = [(int(n), p.tolist()) for n, p in zip(draw.integers(0, 300, 300), posteriors)]
    wanted = np.array(shares) * sum(r[0] for r in rows)
    df = spark.createDataFrame(rows, "n_tokens long, posterior array<double>").repartition(3)
    found = fit_rates(df, wanted.tolist()).collect()
    assert len(found) == 300 and min(r.rate for r in found) >= 0
    totals = sum(r.n_tokens * r.rate * np.array(r.posterior) for r in found)
    plain = plain_least_squares(rows, wanted)
    if met:
        assert np.abs(totals - wanted).max() <= 1e-6 * wanted.sum()
    # Nothing nearer is to be had, and where the optimum is one vector, it is that.
    assert ((totals - wanted) ** 2).sum() <= ((plain - wanted) ** 2).sum() * (1 + 1e-6) + 1e-9
    assert totals == pytest.approx(plain, rel=1e-3)


def test_totals_as_a_table(documents, spark):
    docs = documents([(i, "good words here " * (1 + i % 4)) for i in range(20)] + [(21, None), (None, "")])
    labels = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(20)], "doc_id long, domain string")
    weights = {"a": 0.5, "b": 0.5}
    mixed = mix(docs, labels, weights).cache()
    table = {r.domain: (r.target, r.reached) for r in domain_totals(mixed, weights).collect()}
    assert set(table) == {"a", "b"}
    whole = sum(r.n_tokens for r in mixed.collect())
    assert sum(t for t, _ in table.values()) == pytest.approx(whole)
    assert sum(r for _, r in table.values()) == pytest.approx(whole, rel=1e-3)
    empty = domain_totals(mixed.limit(0), weights).collect()
    assert [(r.domain, r.target, r.reached) for r in empty] == [("a", 0.0, 0.0), ("b", 0.0, 0.0)]


def test_rounds_read_packed_rows(spark):
    # Each round used to read every row of the table anew.
    draw = np.random.default_rng(4)
    posteriors = draw.dirichlet([0.9, 0.3, 0.15], 300)
    rows = [(int(n), p.tolist()) for n, p in zip(draw.integers(0, 300, 300), posteriors)]
    wanted = np.array([0.97, 0.02, 0.01]) * sum(r[0] for r in rows)
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    schema = "n_tokens long, posterior array<double>"
    df = spark.createDataFrame(rows, schema).repartition(3).mapInArrow(count, schema)
    found = fit_rates(df, wanted.tolist()).collect()
    totals = sum(r.n_tokens * r.rate * np.array(r.posterior) for r in found)
    assert np.abs(totals - wanted).max() <= 1e-6 * wanted.sum()
    # The whole, the packing and the result.
    assert read.value == 3 * len(rows)
