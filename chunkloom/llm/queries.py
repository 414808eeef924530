"""The registered queries: each operator with production parameters over its whole table."""

from pyspark.sql import functions as F

from chunkloom.llm.decontaminate import contamination
from chunkloom.llm.embedding_dedup import vector_duplicates
from chunkloom.llm.fingerprint import edited
from chunkloom.llm.merkle import manifest, proof_digest
from chunkloom.llm.minhash import near_duplicates
from chunkloom.llm.mixing import mix
from chunkloom.llm.periodic_runs import periodic_runs
from chunkloom.llm.substring_dedup import substring_dedup
from chunkloom.llm.suffix_array import WORDS, suffix_dedup
from chunkloom.llm.token_counts import token_counts
from chunkloom.llm.toxicity import fit, fold, score_of
from chunkloom.llm.stage import Stage
from chunkloom.llm.url_filter import url_filter
from chunkloom.llm.warc import deduplicated, page_of, register
from chunkloom.sinks.scratch import new_dir

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir):
    register(spark)
    path = new_dir(spark, "archives")
    records = deduplicated(Stage(spark), _table(spark, sf_dir, "pages"))
    records.write.format("warc").mode("append").option("path", path).save()
    schema = "record_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    back = spark.read.format("warc").schema(schema).option("path", path).option("verify", "true").load()
    return back.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


def op2_substring_dedup(spark, sf_dir):
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_minhash(spark, sf_dir):
    out = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op4_embedding_dedup(spark, sf_dir):
    out = vector_duplicates(_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op5_decontamination(spark, sf_dir):
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    out = token_counts(_table(spark, sf_dir, "documents"), str(path))
    over = (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", over)


def op7_url_filter(spark, sf_dir):
    out = url_filter(_table(spark, sf_dir, "pages"), RULES)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op8_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = fit(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", score_of(spark, model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_mixing(spark, sf_dir):
    out = mix(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op10_suffix_array(spark, sf_dir):
    out = suffix_dedup(_table(spark, sf_dir, "documents"), passages=WORDS)
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed",
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_repeated_words",
    )


def op11_fingerprints(spark, sf_dir):
    return edited(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def with_repetitions(docs):
    """Every tenth document by hash repeats a stretch of its words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    g, n = F.floor(h / 10), F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
    said = F.array_join(F.transform(at, lambda i: F.get("words", i)), " ")
    chosen = F.when((h % 10 == 0) & F.col("text").isNotNull(), words)
    split = docs.select("doc_id", "text", chosen.alias("words"))
    return split.select("doc_id", F.when(F.size("words") > 0, said).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    out = periodic_runs(with_repetitions(_table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    out = out.select("*", longest.alias("best"))
    return out.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_merkle(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    claimed = [changed if c == "n_chars" else F.col(c) for c in columns]
    out = manifest(docs, columns, "lang", tampered=claimed)
    return out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
        "folded_root", "verified",
    )


QUERIES = {
    "op1_warc": op1_warc,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_minhash": op3_minhash,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_token_counts": op6_token_counts,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_suffix_array": op10_suffix_array,
    "op11_fingerprints": op11_fingerprints,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_merkle": op13_merkle,
}
