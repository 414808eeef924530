"""Periodic runs against a loop over all periods."""

import hashlib
import random
import zlib

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.llm.periodic_runs import periodic_runs, runs_of, suffix_tree
from chunkloom.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain(w, exponent=4, least=6):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)  # a multiple of a period comes later
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=6), st.integers(1, 7)), max_size=6))
def test_runs_of_repeated_pieces(pieces):
    w = [x for piece, times in pieces for x in piece * times]
    assert runs_of(w) == plain(w)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_tree_has_every_suffix_and_branch(s):
    s = s + [0]
    up, _, depth = suffix_tree(s)
    parents = set(up[1:].tolist())
    leaves = sorted(int(depth[v]) for v in range(1, len(up)) if v not in parents)
    assert leaves == list(range(1, len(s) + 1))
    assert all(depth[v] > depth[up[v]] for v in range(1, len(up)))
    branches = {tuple(s[i : i + n]) for i in range(len(s)) for n in range(1, len(s) - i)}
    after = {b: {s[i + len(b)] for i in range(len(s) - len(b)) if tuple(s[i : i + len(b)]) == b} for b in branches}
    assert len(parents - {0}) == sum(len(a) > 1 for a in after.values())


def edited(doc_id, text):
    w = brute.words((text or "").encode())
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return [x.decode() for x in w]


def test_query(spark):
    found = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(found) == len(table)
    some = 0
    for doc in table:
        w = edited(doc["doc_id"], doc["text"])
        runs, row = plain(w), found[doc["doc_id"]]
        some += bool(runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), s, n, q)
        assert row.exponent_milli == (1000 * n // q if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert some > 5


def test_edges(spark):
    rng = random.Random(5)
    noise = [f"w{rng.randrange(50)}" for _ in range(300)]
    rows = [
        (1, None), (2, ""), (3, "a a a a a"), (4, "a a a a a a"), (None, "é 漢 é 漢\té 漢  é 漢"), (5, "x " + "a b c " * 4 + "a d"),
        (6, " ".join(noise + ["u", "v"] * 9 + noise + noise[:40] * 5)), (4, "a a a a a a"), (7, "  " * 8), (8, "z " * 40_000),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("runs", F.lit(1))
    found = periodic_runs(table).collect()
    assert len(found) == len(rows)
    wanted = []
    for i, text in rows:
        w = [x.decode() for x in brute.words((text or "").encode())]
        runs = [(0, 40_000, 1)] if i == 8 else plain(w)
        wanted.append((i, len(w), runs, collapsed(w, runs)))
    key = lambda r: (str(r[0]), r[1])
    got = [(r.id, r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert periodic_runs(table.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        periodic_runs(table, exponent=2)
