"""Connected components: right on any graph, and no round more than it takes."""

import random

import pytest

from retailloom.llm import shared


@pytest.fixture
def rounds(monkeypatch):
    """How many tables of edges were stored: the graph's own, and one a round."""
    made, stored = [], shared.stored
    monkeypatch.setattr(shared, "stored", lambda *a, **b: made.append(1) or stored(*a, **b))
    return made


def found(spark, edges):
    return {r.node: r.component for r in shared.components(spark.createDataFrame(edges, "a long, b long")).collect()}


def test_stars_take_one_round(spark, rounds):
    assert found(spark, [(5, 1), (1, 7), (1, 7), (9, 9), (4, 2), (None, 2)]) == {1: 1, 5: 1, 7: 1, 2: 2, 4: 2}
    assert len(rounds) == 2


def test_no_edges(spark, rounds):
    assert found(spark, [(3, 3), (None, 1)]) == {}
    assert len(rounds) == 2


def test_chains_and_random_graphs(spark):
    dealt = random.Random(3)
    edges = [(i, i + 1) for i in range(1000, 1040)] + [(dealt.randrange(60), dealt.randrange(60)) for _ in range(45)]
    own = {x: x for e in edges for x in e}
    for _ in own:
        for a, b in edges:
            own[a] = own[b] = min(own[a], own[b])
    assert found(spark, edges) == {x: c for x, c in own.items() if any(x in e and e[0] != e[1] for e in edges)}
