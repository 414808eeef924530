"""Fingerprints against a byte-by-byte version, edit distance against its table, neighbours against a loop."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.llm import fingerprint as fp
from chunkloom.llm.numeric import BLOCK_BYTES, U, bytes_sequence, word_hashes
from chunkloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(text):
    """One window at a time, one chunk at a time."""
    data = text.encode()
    buf = np.frombuffer(data, np.uint8)
    grams = bytes_sequence(buf, 0).grams(fp.CONTEXT).tolist() if len(data) else []

    def chunks(size):
        begin = 0
        for i, g in enumerate(grams):
            if g % size == size - 1:
                yield begin, i + fp.CONTEXT
                begin = i + fp.CONTEXT
        if begin < len(data):
            yield begin, len(data)

    def code(a, b):
        one = int(word_hashes(buf[a:b], np.array([0]), np.array([b - a]), 0)[0]) % 4096
        return chr(fp._CODE[one // 64]) + chr(fp._CODE[one % 64])

    size = 1 << fp.LEAST_BITS
    while sum(g % size == size - 1 for g in grams) >= fp.CHUNKS:
        size *= 2
    return ":".join([str(size), *("".join(code(a, b) for a, b in chunks(s)) for s in (size, 2 * size))])


def one(text):
    data = text.encode()
    return fp.fingerprints_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def texts():
    return dict(pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).select([0, 1]).to_pandas().values.tolist())


def test_every_text_is_fingerprinted_as_by_plain_loops(texts):
    for text in ["", "x", "word", "x" * 3000, "ab" * 5000, *texts.values()]:
        assert one(text) == plain(text)
    together = list(texts.values())
    data = "".join(together).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in together])
    assert fp.fingerprints_of(np.frombuffer(data, np.uint8), offsets) == [plain(t) for t in together]


def test_texts_longer_than_a_piece():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2 * BLOCK_BYTES + 77))
    assert one(text) == plain(text)
    assert fp.likeness_of(one(text), one(text[: -len(text) // 4])) > 0.4


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["AA", "AB", "BA", "zz"]), max_size=80), st.lists(st.sampled_from(["AA", "AB", "BA", "zz"]), max_size=80))
def test_edit_distance(a, b):
    assert fp.edit_distance("".join(a), "".join(b)) == distance(a, b)


def test_likeness():
    assert fp.likeness_of("4::", "4::") == 1 and fp.likeness_of("4::", "4:AA:AA") == 0
    assert fp.likeness_of("4:AABBCC:AACC", "8:AACCDD:AA") == pytest.approx(2 / 3)  # at 8
    assert fp.likeness_of("16:AA:AA", "4:AA:AA") == 0


def test_query(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op11_fingerprints"](spark, SF).collect()}
    ids = sorted(texts)
    assert sorted(found) == ids
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, row = texts[i], found[i]
        n = len(text) // 4
        edited = text[: len(text) - n] + texts[after][:n]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (plain(text), plain(edited))
        assert row.near_edited == fp.likeness_of(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == fp.likeness_of(row.fingerprint, plain(texts[after]))
    mean = [sum(r[c] for r in found.values()) / len(found) for c in ("near_edited", "near_next")]
    assert mean[0] > 0.6 and mean[1] < 0.05


def test_edges(spark):
    rows = [(3, "ccc dd"), (1, None), (2, ""), (2, "two é漢"), (None, "no id"), (3, "ccc dd")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(1)).withColumn("part", F.lit("x"))
    found = fp.edited(table.repartition(3)).collect()
    assert len(found) == len(rows)
    by = {(r.id, r.n_chars): r for r in found}
    assert by[1, 0].near_edited == 1 and by[1, 0].fingerprint == "4::"
    assert by[2, 6].edited_sha256 in {hashlib.sha256(f"two é{c}".encode()).hexdigest() for c in ("c", "")}
    assert {r.near_next for r in found if r.id == 3} == {1.0, 0.0}  # its copy, and the first row
    alone = fp.edited(table.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1
    assert fp.edited(table.limit(0)).isEmpty()
    both = table.select(fp.fingerprint(F.col("text")).alias("f"))
    assert both.where(fp.likeness(F.col("f"), F.col("f")) == 1).count() == len(rows)
