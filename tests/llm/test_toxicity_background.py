"""Marks that share a short stem only, in texts of the same syllables as all others."""

import random

import numpy as np
import pandas as pd

from tablelab.llm import toxicity


def _texts(n: int, seed: int) -> pd.DataFrame:
    r = random.Random(seed)
    parts = [[a + b for a in x for b in y] for x, y in (("bdklmnrst", "aeiou"), ("cfgpvz", ("an", "er", "il")))]

    def text(bad: bool) -> str:
        own = parts[r.random() < 0.2]
        words = ["".join(r.choices(own, k=r.randint(1, 4))) for _ in range(r.randint(60, 250))]
        for _ in range(r.randint(2, 6) if bad else 0):
            words.insert(r.randrange(len(words)), "wuqo" + "".join(r.choices(own, k=r.randint(1, 2))))
        return " ".join(words)

    toxic = [int(i % 8 == 0) for i in range(n)]
    return pd.DataFrame({"text": [text(bool(t)) for t in toxic], "toxic": toxic})


def test_short_stems_are_told_from_chance_matches():
    model = toxicity.fit(_texts(1600, 1), 0.125)
    pair = toxicity._pair([bytes.fromhex(b) for b in model["books"]])
    asked = _texts(400, 2)
    x = np.array([toxicity._features(toxicity._plain(t), pair) for t in asked["text"]])
    z = model["beta"][0] + ((x - model["mean"]) / model["spread"]) @ np.array(model["beta"][1:])
    y = asked["toxic"].to_numpy() == 1
    assert (z[y] > np.quantile(z[~y], 0.9)).mean() > 0.75  # 0.40 with a dictionary of runs for each class
