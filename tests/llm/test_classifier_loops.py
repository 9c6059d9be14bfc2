"""Classifier parts against plain loops."""

import math
import random

import numpy as np
import pytest

from klinark.llm import toxicity


def plain_risk(z, toxic, prior):
    positive = [v for v, t in zip(z, toxic) if t]
    unlabelled = [v for v, t in zip(z, toxic) if not t]
    called_clean = lambda v: math.log1p(math.exp(-abs(v))) + max(v, 0)
    first = prior * sum(called_clean(-v) for v in positive) / len(positive)
    second = (sum(called_clean(v) for v in unlabelled) / len(unlabelled)
              - prior * sum(called_clean(v) for v in positive) / len(positive))
    return first, second


@pytest.mark.parametrize("seed", range(6))
def test_risk_and_slope_equal_plain_loops(seed):
    draw = random.Random(seed)
    z = np.array([draw.uniform(-4, 4) for _ in range(30)])
    toxic = np.array([draw.random() < 0.4 for _ in range(30)])
    toxic[:2] = True, False
    prior = draw.choice([0.05, 0.5, 0.95])
    first, second = plain_risk(z, toxic, prior)
    assert np.allclose(toxicity.pu_risk(z, toxic, prior), (first, second))
    # the slope is the gradient of first + second, or of -second where the second part is negative
    for i in range(30):
        up, down = z.copy(), z.copy()
        up[i], down[i] = up[i] + 1e-6, down[i] - 1e-6
        a, b = plain_risk(up, toxic, prior), plain_risk(down, toxic, prior)
        wanted = (a[0] + a[1] - b[0] - b[1]) / 2e-6 if second >= 0 else -(a[1] - b[1]) / 2e-6
        assert abs(toxicity.pu_slope(z, toxic, prior)[i] - wanted) < 1e-6


def test_few_toxic_rows_allow_small_weights_only():
    draw = np.random.default_rng(0)
    def sample(toxic):
        rows = [np.flatnonzero(draw.random(40) < 0.3) for _ in range(toxic + 200)]
        marks = np.arange(toxic + 200) < toxic
        for i in range(toxic):
            rows[i] = np.unique(np.append(rows[i], 7))
        return toxicity.fit(rows, marks, np.arange(40), 0.1)
    few, many = sample(5), sample(100)
    assert np.abs(few.weights).max() < np.abs(many.weights).max()
    assert many.weights.argmax() == 7


def test_a_model_scores_like_a_plain_sum():
    words = ["bad", "worse", "fine"]
    keys = np.sort(np.concatenate([toxicity.word_keys(w) for w in words]))
    model = toxicity.ToxicModel(keys, np.array([1.5, -2.0, 0.25]), -0.5)
    for text in ["", None, "BAD bad, worse?", "other", "fine fine"]:
        own = {int(k) for k in toxicity.word_keys(text)}
        total = -0.5 + sum(w for k, w in zip(keys.tolist(), model.weights) if k in own)
        assert abs(model.score(text) - 1 / (1 + math.exp(-total))) < 1e-12
