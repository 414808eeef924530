"""The hashed Kneser-Ney models against one counted in dictionaries, without slots."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from chunkloom.llm import toxicity as tox
from chunkloom.llm.stage import Stage


def grams(text):
    """(gram of five, of three, of two, byte) that end at each byte, shorter at the start of the text."""
    for i in range(1, len(text) + 1):
        yield tuple(text[max(0, i - k) : i] for k in tox.ORDERS[::-1]) + (text[i - 1 : i],)


class Plain:
    def __init__(self, rows):
        self.uses = [Counter(), Counter()]
        longer = [defaultdict(set) for _ in range(3)]  # of three, two and one
        for text, label in rows:
            for five, three, two, one in grams(text.lower().encode()):
                self.uses[label][five] += 1
                longer[0][three].add(five)
                longer[1][two].add(three)
                longer[2][one].add(two)
        self.shared = [Counter({g: len(s) for g, s in each.items()}) for each in longer]
        self.contexts = {}
        for name, counts in [(0, self.uses[0]), (1, self.uses[1]), (3, self.shared[0]), (2, self.shared[1])]:
            total, kinds = Counter(), Counter()
            for g, n in counts.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            self.contexts[name] = (counts, total, kinds)
        self.total = sum(self.shared[2].values()) + 128

    def step(self, name, gram, below):
        counts, total, kinds = self.contexts[name]
        context = gram[:-1]
        if not total[context]:
            return below
        own = max(counts[gram] - tox.DISCOUNT, 0) / total[context]
        return own + tox.DISCOUNT * kinds[context] / total[context] * below

    def log_likelihoods(self, text):
        out = []
        for five, three, two, one in grams(text.lower().encode()):
            p = (self.shared[2][one] + 0.5) / self.total
            p = self.step(2, two, p)
            p = self.step(3, three, p)
            out.append([math.log(self.step(c, five, p)) for c in (0, 1)])
        return np.array(out)


@pytest.fixture
def rows():
    rng = random.Random(9)
    out = []
    for i in range(120):
        words = ["bad" if i % 3 == 0 and rng.random() < 0.3 else rng.choice(["abba", "deaf", "face", "fed"]) for _ in range(9)]
        out.append((" ".join(words), int(i % 3 == 0)))
    return [*out, ("", 1), ("A", 0)]


def test_models_equal_a_plain_one(spark, rows):
    table = spark.createDataFrame(rows, "text string, toxic int").repartition(3)
    model = tox.count_model(Stage(spark), table)
    plain = Plain(rows)
    for text in ("a bad face", "abba fed", "zzz bad", "BAD", "x"):
        buf = np.frombuffer(text.encode(), np.uint8)
        lowered, _, begin = tox._lowered(buf, np.array([0, len(buf)]))
        found = np.column_stack(model.log_likelihoods(lowered, begin))
        assert np.allclose(found, plain.log_likelihoods(text), atol=1e-4), text
        n, _, whole = model.statistic(buf, np.array([0, len(buf)]))
        wanted = plain.log_likelihoods(text)
        assert n[0] == len(text) and whole[0] == pytest.approx((wanted[:, 1] - wanted[:, 0]).mean(), abs=1e-4)


def test_one_class_gives_no_model(spark, rows):
    table = spark.createDataFrame([r for r in rows if r[1]], "text string, toxic int")
    assert tox.count_model(Stage(spark), table) is None
    assert tox.count_model(Stage(spark), table.limit(0)) is None
