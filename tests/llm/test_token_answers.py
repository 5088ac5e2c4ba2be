"""Limits and quantiles asked of the length histogram, against plain counting."""

import math
import random

import pytest

from conftest import rows
from quayside.llm import token_counts


def lengths(seed, n=400):
    """Lengths with ties, zeros, a hot one, and a few very long."""
    rng = random.Random(seed)
    return [rng.choice([0, 7, 7, 7, rng.randrange(300), rng.randrange(5000, 200_000)]) for _ in range(n)]


def table_of(spark, values):
    counts = spark.createDataFrame([(v,) for v in values], "n_tokens long").repartition(5)
    return token_counts.totals(counts)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_limit_and_share(spark, seed):
    values = sorted(lengths(seed))
    table = table_of(spark, values)
    limits = [0, 1, 6, 7, 8, 250, 4999, 5000, values[-1] - 1, values[-1], values[-1] + 10, 7]
    expected = sorted(
        (
            limit,
            sum(v > limit for v in values),
            sum(v <= limit for v in values),
            sum(v for v in values if v <= limit),
            sum(min(v, limit) for v in values),
        )
        for limit in set(limits)
    )
    assert rows(token_counts.at_limits(table, limits)) == expected
    shares = [0.001, 0.25, 0.5, 0.99, 1.0, 0.5]
    smallest = sorted({(q, values[math.ceil(q * len(values)) - 1]) for q in shares})
    assert rows(token_counts.quantiles(table, shares)) == smallest


def test_limits_below_all_lengths(spark):
    table = table_of(spark, [5, 5, 9])
    assert rows(token_counts.at_limits(table, [3])) == [(3, 3, 0, 0, 9)]


def test_empty_tables_and_bad_questions(spark):
    table = table_of(spark, [])
    assert rows(token_counts.at_limits(table, [0, 5])) == rows(token_counts.quantiles(table, [0.5])) == []
    full = table_of(spark, [1])
    assert rows(token_counts.at_limits(full, [])) == rows(token_counts.quantiles(full, [])) == []
    with pytest.raises(ValueError):
        token_counts.at_limits(full, [-1])
    with pytest.raises(ValueError):
        token_counts.quantiles(full, [0.0])
