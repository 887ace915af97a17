"""Recall of the embedding join in few and many dimensions, against all pairs."""

import numpy as np
import pytest

from cohortry.llm import embed


@pytest.mark.parametrize("d", [1, 2, 3, 8, 64, 384])
def test_recall(spark, d):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((400, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(100):  # pairs at 0.9 to 0.95
        z = rng.standard_normal(d)
        z -= (z @ x[i]) * x[i]
        c = rng.uniform(0.9, 0.95)
        if d > 1:
            x[300 + i] = c * x[i] + np.sqrt(1 - c * c) * z / np.linalg.norm(z)
    got = {r.vec_id: r.n_links for r in embed.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert all(got[i] <= n for i, n in enumerate(want)) or d == 1
    assert sum(got.values()) >= 0.9 * want.sum() > 0
