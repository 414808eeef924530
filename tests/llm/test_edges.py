"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import pytest
from pyspark.sql import functions as F

from chunkloom.llm.decontaminate import contamination, drop_contaminated
from chunkloom.llm.embedding_dedup import vector_duplicates
from chunkloom.llm.minhash import drop_near_duplicates, near_duplicates
from chunkloom.llm.mixing import mix, mixed
from chunkloom.llm.stage import Stage
from chunkloom.llm.substring_dedup import substring_dedup
from chunkloom.llm.suffix_array import WORDS, suffix_dedup, trim_repeats
from chunkloom.llm.toxicity import drop_toxic, fit, score_of
from chunkloom.llm.url_filter import url_filter
from chunkloom.llm.warc import deduplicated, register
from tests.llm import brute

# names that the operators use inside
SCHEMA = "doc_id long, text string, source string, id string, h long, n long, ranges int, label int, bucket int"


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta épée 漢字 eta theta iota kappa lambda".split()) + str(rng.randrange(40)) for _ in range(n))


def texts():
    shared, long_text = passage(1, 120), passage(2, 9000)
    return [
        None, "", "  \n", "one", "ONE", "two words", shared, shared, shared + " tail", "head " + shared,
        passage(3, 70) + " " + shared[:500] + " " + passage(4, 30), long_text, long_text + " more",
        "x" * 3000, shared.replace("alpha", "ALPHA", 1),
    ]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ["a", "b", None][i % 3], "c", 1, None, 2, None, 3) for i, t in enumerate(texts())]
    return out + [out[6], out[0], (None, "without id", "a", "c", 1, 1, 1, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(rows):
    return list({r[0]: (r[0], r[1]) for r in rows if r[0] is not None}.values())


def test_near_duplicates(docs, rows):
    found = near_duplicates(docs, shingle=3, percent=85).collect()
    assert len(found) == len(rows)
    wanted = brute.near(plain(rows), 3, 85)
    assert {r.id: (r.n_shingles, r.component_id) for r in found if r.id is not None} == wanted
    (lone,) = [r for r in found if r.id is None]
    assert lone.kept and lone.component_id is None
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    groups = brute.near(plain(rows), 5, 80)
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, g) in groups.items() if i == g)
    assert ids.count(None) == 1


def test_substring_dedup(docs, rows):
    out = substring_dedup(docs).select("id", "n_words", "n_removed", F.sha2("kept", 256).alias("k")).collect()
    assert len(out) == len(rows)
    assert {r.id: (r.n_words, r.n_removed, r.k) for r in out if r.id is not None} == brute.repeated_words(plain(rows), 50)


def test_suffix_array(docs, rows):
    out = suffix_dedup(docs).select(
        "id", "n_bytes", "n_removed", F.size("spans").alias("s"), F.sha2("kept", 256).alias("k")
    )
    out = out.collect()
    assert len(out) == len(rows)
    # a repeated row is a copy, so both lose what they hold
    twice = plain(rows) + [(-1, texts()[6])]
    wanted = brute.repeated_bytes(twice, 400)
    wanted.pop(-1)
    assert {r.id: (r.n_bytes, r.n_removed, r.s, r.k) for r in out if r.id is not None} == wanted
    cut = trim_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    wanted = brute.trimmed(plain(rows), 50)
    for r in cut.collect():
        if r.doc_id is not None:
            assert brute.words((r.text or "").encode()) == wanted[r.doc_id]
            assert (r.text is None) == (texts()[r.doc_id] is None)


def test_bytes_and_words_in_the_same_passes(docs, rows, monkeypatch):
    """Passages of words add no steps of their own, and change nothing about the bytes."""
    steps, table = [], Stage.table
    monkeypatch.setattr(Stage, "table", lambda self, df, name: steps.append(name) or table(self, df, name))
    columns = ["id", "n_bytes", "n_removed", "spans", "kept"]
    alone = suffix_dedup(docs).select(columns).collect()
    once, steps[:] = list(steps), []
    both = suffix_dedup(docs, passages=WORDS)
    assert steps == once
    assert both.columns == [*columns, "n_repeated_words"]
    both = both.collect()
    key = str
    assert sorted((r[:5] for r in both), key=key) == sorted(map(tuple, alone), key=key)
    wanted = brute.words_elsewhere(plain(rows) + [(-1, texts()[6])], 50)
    wanted.pop(-1)
    assert {r.id: r.n_repeated_words for r in both if r.id is not None} == wanted


def test_suffixes_of_a_text_in_segments(spark):
    """A passage across the cut of a text of several segments, once more in it, and in another text."""
    rng = random.Random(8)
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=9_000_000))
    shared = noise[: 4 << 20][-700:] + noise[4 << 20 :][:900]
    at = (4 << 20) - 700
    long = noise[:8_600_000] + shared + noise[8_600_000:]
    table = spark.createDataFrame([(1, long), (2, "x" + shared + "é"), (3, None)], "doc_id long, text string")
    found = {r.id: r for r in suffix_dedup(table).collect()}
    n = len(shared)
    assert [tuple(s) for s in found[1].spans] == [(at, at + n), (8_600_000, 8_600_000 + n)]
    assert [tuple(s) for s in found[2].spans] == [(1, 1 + n)] and found[2].n_bytes == n + 3
    assert bytes(found[1].kept) == (long[:at] + long[at + n : 8_600_000] + long[8_600_000 + n :]).encode()
    assert found[3].n_bytes == 0


def test_contamination(spark, docs, rows):
    words = texts()[6].split()
    items = [(1, " ".join(words[20:40])), (1, " ".join(words[20:40])), (10, "One"), (2, None), (3, ""), (None, "one")]
    items = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs, items).collect()
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    assert by_id[3].items == by_id[4].items == ["10"] and by_id[3].contaminated
    assert by_id[6].n_hit == 20 and by_id[6].items == ["1"] and by_id[6].contaminated
    assert by_id[0].n_words == 0 and not by_id[0].contaminated
    assert by_id[11].n_hit == 0 and not by_id[11].contaminated
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    gone = {r.id for r in found if r.contaminated}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r[0] or -1 for r in rows if r[0] not in gone)
    assert contamination(docs, items.limit(0)).where("contaminated").isEmpty()


def test_embeddings(spark):
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 1.0]), (5, None), (6, []), (7, [0.0, 0.0]),
        (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, [float("inf"), 1.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.0]),
        (None, [1.0, 0.0]), (13, [1.0, 0.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    found = {r.id: (r.n_links, r.component_id, r.kept) for r in vector_duplicates(table).collect()}
    assert len(found) == len(rows)
    assert found[1] == (3, 1, True)
    assert found[2] == found[3] == found[12] == (3, 1, False)
    assert found[11] == (1, 11, True) and found[13] == (1, 11, False)
    for i in (4, 5, 6, 7, 8, 9, 10):
        assert found[i] == (0, i, True)
    assert vector_duplicates(table.limit(0)).isEmpty()


def test_mix(docs, rows):
    found = mix(docs).collect()
    assert len(found) == len(rows)
    assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 2 for r in found)
    out = mixed(docs)
    assert out.columns == docs.columns + ["copy"]
    assert out.count() == sum(r.copies for r in found)


def test_toxicity(spark, docs, rows):
    bad, good = "you utter vile wretch", "a calm walk in the park"
    more = [(100 + i, f"{bad if i % 2 else good} {i}", "a", "c", 1, 1, 1, 1, 1) for i in range(200)]
    table = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    labels = [(100 + i, 1, i % 2) for i in range(200)] + [(6, 1, None), (None, 1, 1), (3, 1, 0), (3, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit(table, labels)
    scores = {r.doc_id: r.s for r in table.select("doc_id", score_of(spark, model, F.col("text")).alias("s")).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[0] == scores[1] < 0.5
    assert all((scores[100 + i] >= 0.5) == bool(i % 2) for i in range(200))
    kept = drop_toxic(table, labels)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.5}
    assert drop_toxic(table, labels.limit(0)).count() == table.count()


def test_urls(spark):
    rules = [("allow", "com", "/"), ("block", "net", "/es/")]
    urls = [None, "", "nothing", "http://A.COM/x?y#z", "http://b.net/es/1", "http://b.net", "://", "http://b.net/es/1"]
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1))
    found = {r.id: r for r in url_filter(table, rules).collect()}
    assert len(found) == len(urls)
    assert (found[3].host, found[3].path, found[3].rule, found[3].verdict) == ("a.com", "/x", "com/", "allow")
    assert found[4].rule == found[7].rule == "net/es/" and found[4].verdict == "block"
    assert (found[0].host, found[0].path, found[0].rule) == ("", "", None)
    assert {r.verdict for r in found.values()} <= {"allow", "block"}
    assert url_filter(table.limit(0), rules).isEmpty()


def test_archives(spark, tmp_path):
    register(spark)
    pages = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "http://c/", None), (4, "http://d/", ""), (5, "u", "é" * 70000)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    records = deduplicated(Stage(spark), table)
    path = str(tmp_path / "archives")
    records.write.format("warc").mode("append").option("path", path).save()
    schema = "record_id string, payload_bytes long, record_type string, refers_to string, payload binary"
    back = spark.read.format("warc").schema(schema).option("path", path).option("verify", "true").load()
    found = back.collect()
    assert sorted(r.record_type for r in found) == ["response"] * 3 + ["revisit"] * 2
    assert sorted(r.payload_bytes for r in found) == [0, 0, 1, 1, 140000]
    whole = [bytes(r.payload) for r in found if r.record_type == "response"]
    assert sorted(whole) == sorted([b"", b"x", ("é" * 70000).encode()])
    assert back.where("record_type = 'revisit'").count() == 2


def test_token_splices():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from chunkloom.llm.token_counts import count_huge

    whole = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    for text in ("", passage(5, 3000), "z" * 5000, passage(6, 200) + "y" * 4000 + passage(7, 200), " \n" * 3000):
        assert count_huge(text, whole, chunk=512, overlap=16) == len(whole.encode(text, add_special_tokens=False).ids)


def test_empty_tables(empty):
    for found in (
        near_duplicates(empty), substring_dedup(empty), suffix_dedup(empty), mix(empty), mixed(empty),
        drop_near_duplicates(empty), trim_repeats(empty),
    ):
        assert found.isEmpty()
