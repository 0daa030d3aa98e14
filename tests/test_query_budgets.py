"""The queries of search and inspection run the operators' whole jobs, not cut ones."""

import inspect

import pytest

from credspark import constants as K
from credspark.operators import models as M
from credspark.operators import tuning as TU
from credspark.plans import q_ml
from credspark.plans.common import apps


class Called(Exception):
    pass


def arguments(monkeypatch, spark, sf, module, operator, query):
    """What ``query`` gives to ``operator``, with the defaults of what it leaves out."""
    names = inspect.signature(getattr(module, operator))

    def stop(*a, **k):
        got = names.bind(*a, **k)
        got.apply_defaults()
        raise Called(got.arguments)

    monkeypatch.setattr(module, operator, stop)
    with pytest.raises(Called) as e:
        query(spark, sf)
    return e.value.args[0]


def test_search_query_runs_every_trial(monkeypatch, spark, sf):
    got = arguments(monkeypatch, spark, sf, TU, "tune_search", q_ml.q_tune_search)
    assert (got["model"], got["n_trials"], got["folds"]) == ("lrc", 25, 5)


def test_learning_curve_query_runs_every_size(monkeypatch, spark, sf):
    got = arguments(monkeypatch, spark, sf, TU, "learning_curve", q_ml.q_learning_curve)
    assert (got["sizes"] is None or len(got["sizes"]) == 10) and got["folds"] == 5


def test_permutation_query_shuffles_every_feature(monkeypatch, spark, sf):
    monkeypatch.setattr(M, "train_logistic", lambda *a, **k: None)
    got = arguments(monkeypatch, spark, sf, TU, "permutation_importance", q_ml.q_permutation_importance)
    assert set(got["columns"]) == set(apps(spark, sf).columns) - {K.ROW_ID, K.TARGET} and got["repeats"] == 10
