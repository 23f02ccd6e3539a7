"""Registered queries do the whole job of their operators: sizes as published."""

import inspect
import itertools
import types

import pytest

from fundloom.operators import boosting as B, clusters as C, models as M
from fundloom.plans import all_queries, registry

all_queries.load()


class Asked(Exception):
    pass


def asked(monkeypatch, spark, folder, module, operator, query):
    """What the query calls the operator with, defaults included."""
    real = getattr(module, operator)

    def stop(*args, **kw):
        bound = inspect.signature(real).bind(*args, **kw)
        bound.apply_defaults()
        raise Asked(bound.arguments)

    monkeypatch.setattr(module, operator, stop)
    with pytest.raises(Asked) as got:
        registry.QUERIES[query](spark, folder)
    return types.SimpleNamespace(**got.value.args[0])


def test_every_k_and_every_resample(monkeypatch, spark, folder):
    assert list(asked(monkeypatch, spark, folder, C, "choose_k", "choose_k").ks) == list(range(2, 11))
    assert asked(monkeypatch, spark, folder, C, "cluster_stability", "cluster_stability").n == 100


@pytest.mark.parametrize("query", ["activity_scores", "stream_scoring"])
def test_lead_forests_have_all_trees(monkeypatch, spark, folder, query):
    fit = asked(monkeypatch, spark, folder, M, "fit_lead_model", query)
    assert (fit.trees, fit.depth, fit.algo) == (200, None, "rf")
    assert [M.lead_estimator(["a"], [], "y", algo).getStages()[-1].getMaxDepth() for algo in ("rf", "gbt")] == [12, 6]


def test_boosted_trees_have_all_rounds(monkeypatch, spark, folder):
    fit = asked(monkeypatch, spark, folder, B, "boost", "boosted_lead_model")
    assert fit.rounds == 200 and [s.depth for s in fit.specs] == [6]


def test_the_whole_grid(monkeypatch, spark, folder):
    boost = asked(monkeypatch, spark, folder, B, "boost", "lead_grid_search")
    assert boost.rounds == 240 and list(boost.stages) == [180, 240] and len(boost.specs) == 48
    assert {(s.depth, s.step, s.rows, s.columns) for s in boost.specs} == set(itertools.product([5, 6], [0.04, 0.06], [0.85, 0.95], [0.85, 0.95]))
    assert {s.fold for s in boost.specs} == {0, 1, 2}
