"""Regressions with the same coefficients share their second derivatives and still end at their own optimum."""

import numpy as np

from credspark.operators import batch_fits as BF


def test_equal_models_share_second_derivatives(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    y = (x @ [1.5, -2.0, 0.5, 0.0] + rng.logistic(size=600) > 0).astype(int)
    rows = spark.createDataFrame([(int(c), v.tolist()) for c, v in zip(y, x)], "class int, x array<double>").cache()
    sent = []
    summed = BF.summed
    monkeypatch.setattr(BF, "summed", lambda parts, size: sent.append(size) or summed(parts, size))
    regs = [1e-4, 1.1e-4, 1.2e-4, 0.3, 10.0]
    weights = [None, None, {0: 2.0, 1: 1.0}, None, None]
    shared = BF.logistic_many(rows, regs, weights)
    monkeypatch.setattr(BF, "_alike", lambda c, w: (list(range(len(c))), list(range(len(c)))))
    full = len(sent)
    assert np.allclose(shared, BF.logistic_many(rows, regs, weights), atol=1e-9)
    # five models with 7 numbers of their own; at the start two kinds of class weights make two matrices of 5 x 5
    assert sent[0] == 5 * 7 + 2 * 25 and sent[full] == 5 * 7 + 5 * 25 and sum(sent[:full]) < sum(sent[full:])
