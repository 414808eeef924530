"""Components against union-find, and vector cells against all products."""

import random

import numpy as np
from pyspark.sql import functions as F

from chunkloom.llm.embedding_dedup import vector_duplicates
from chunkloom.llm.links import components
from chunkloom.llm.stage import Stage
from tests.llm import brute


def test_components(spark):
    """A chain, a star, random links, a pair both ways, a loop, repeated links and no link at all."""
    rng = random.Random(11)
    chain = [(i, i + 1) for i in range(0, 300)]
    rng.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 400)]
    loose = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    links = [*chain, *star, *loose, *loose[:50], (3001, 3000), (3000, 3001), (4000, 4000)]
    table = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.label for r in components(Stage(spark), table).collect()}
    wanted = brute.groups({i for link in links for i in link}, links)
    assert found == {i: g for i, g in wanted.items() if i != g}
    assert components(Stage(spark), table.limit(0)).isEmpty()


def test_vectors_over_many_cells(spark):
    """Families of near copies, many of them across the borders of cells, against all products."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(500, 12))
    family = np.concatenate([np.arange(500), rng.integers(0, 500, 1500), np.full(200, 7)])
    vectors = centers[family] + rng.normal(scale=0.22, size=(len(family), 12))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = np.argwhere(np.triu(unit @ unit.T >= 0.9, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.id: r for r in vector_duplicates(table, cell=100).collect()}
    assert len(found) == len(rows) and len(close) > 3000
    links = sum(r.n_links for r in found.values())
    assert 0.99 * 2 * len(close) <= links <= 2 * len(close)
    wanted = brute.groups(range(len(rows)), [tuple(map(int, p)) for p in close])
    assert all(r.component_id >= wanted[i] and r.kept == (r.component_id == i) for i, r in found.items())
    same = sum(r.component_id == wanted[i] for i, r in found.items())
    assert same >= 0.99 * len(rows)
