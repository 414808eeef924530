"""Merkle manifests against plain loops; the query against SQL is among the query tests."""

import hashlib

import pytest
from pyspark.sql import functions as F

from chunkloom.llm.merkle import manifest, proof_digest

SCHEMA = "doc_id long, text string, lang string, id string, tree int, place int, steps string"


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, p, arity):
    for level in tree[:-1]:
        first = p - p % arity
        yield "".join(level[first:p]), "".join(level[p + 1 : first + arity])
        p //= arity


def plain(rows, arity, changed):
    """(id, leaf, subroot, root, proof, folded root) of every row (doc_id, text, lang)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        group = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((group, levels([leaf(*r) for r in group], arity)))
    top = levels([tree[-1][0] for _, tree in trees], arity)
    for i, (group, tree) in enumerate(trees):
        for p, r in enumerate(group):
            steps = [*path(tree, p, arity), *path(top, i, arity)]
            node = leaf(*changed(r))
            for before, after in steps:
                node = digest(before + node + after)
            yield r[0], tree[0][p], tree[-1][0], top[-1][0], digest("".join(b + a for b, a in steps)), node


def changed(r):
    return (r[0], "other", r[2]) if r[0] is not None and r[0] % 3 == 0 else r


@pytest.mark.parametrize(("arity", "depth"), [(2, 10), (2, 2), (2, 1), (3, 2), (5, 1)])
def test_manifest(spark, arity, depth):
    rows = [(i, f"text {i}", "en") for i in range(37)] + [(i, "é漢", None) for i in range(5)]
    rows += [(None, None, "en"), (None, "", "de"), (7, "again", "en"), (7, "again", "en"), (7, "again", "en"), (1, "", "")]
    rows += [(i, "x", f"l{i % 9}") for i in range(60, 90)] + [(3, "one", "zz")]
    table = spark.createDataFrame([(*r, "c", 1, 2, "s") for r in rows], SCHEMA).repartition(5)
    other = F.when(F.col("doc_id") % 3 == 0, "other").otherwise(F.col("text"))
    found = manifest(
        table, ["doc_id", "text", "lang"], "lang", tampered=[F.col("doc_id"), other, F.col("lang")], arity=arity, depth=depth
    )
    found = found.withColumn("proof", proof_digest(F.col("steps"))).collect()
    got = [(r.id, r.leaf, r.subroot, r.root, r.proof, r.folded_root) for r in found]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(plain(rows, arity, changed), key=key)
    assert all(r.verified == (r.folded_root == r.root) for r in found)
    assert {r.verified for r in found if r.id is not None and r.id % 3 == 0} == {False}
    assert all(r.verified for r in found if r.id is None or r.id % 3)


def test_one_row_and_none(spark):
    table = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    (row,) = manifest(table, ["doc_id", "text"], "lang").collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == leaf(1, "a") and row.steps == []
    assert manifest(table.limit(0), ["doc_id", "text"], "lang").isEmpty()
