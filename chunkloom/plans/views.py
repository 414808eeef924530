"""Inputs of the registered queries, derived by Spark from the given tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.text import hash_content, language_of, record_id

EXTENSIONS = [".md", ".MDX", ".go", ".py", ".ts", ".rs", ".txt", ""]
NOW = datetime(2024, 6, 1)
_NO_VECTOR = "array<float>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when the input has fewer splits than the cluster has slots.

    A large table has more splits than slots and is left as it is.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots * 2) if df.rdd.getNumPartitions() < slots else df


def ext_of(number: Column, extensions: list[str]) -> Column:
    names = F.array(*[F.lit(e) for e in extensions])
    return F.get(names, (number % len(extensions)).cast("int"))


def _lines(text: Column, line) -> Column:
    return F.array_join(F.transform(F.split(text, "\n", -1), line), "\n")


def md_content(text: Column) -> Column:
    """Every third line becomes a heading."""
    return _lines(text, lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("## "), x)).otherwise(x))


def md_numbered(text: Column) -> Column:
    """Every second line becomes one of three headings, so headings repeat in a file."""
    return _lines(
        text,
        lambda x, i: F.when(
            i % 2 == 0, F.concat(F.lit("# s"), (i % 3).cast("string"), F.lit("\n"), x)
        ).otherwise(x),
    )


def _forms(templates: list[str]):
    """One template per line in turn; ``{i}`` is the line number, ``{x}`` the line."""

    def line(x, i):
        number = i.cast("string")
        forms = []
        for t in templates:
            t = F.replace(F.lit(t), F.lit("{i}"), number)
            forms.append(F.replace(t, F.lit("{x}"), x))
        chosen = F.when(i % len(templates) == 0, forms[0])
        for k, form in enumerate(forms[1:], 1):
            chosen = chosen.when(i % len(templates) == k, form)
        return chosen

    return line


GO_FORMS = [
    "func F{i}() {\n\t// {x}\n\tvar in = 1\n}",
    'func (r *T{i}) M{i}(a int) string {\n\treturn "}{" // {x}\n}',
    "const (\n\tA{i}, B{i} = 1, 2\n\tC{i} = 3 +\n\t\t4 // {x}\n)",
    "type (\n\tS{i} struct {\n\t\ta int // {x}\n\t}\n\tI{i} interface{}\n)",
    "/* {x} */\nvar V{i}, W{i} = func() int { return '{' }(), 2",
    "var R{i} = `\nfunc fake() {\n{x}`\ntype N{i} = int",
]
PY_FORMS = [
    "def f{i}():\n    # {x}\n    return {i}\n    # end",
    "@deco\ndef g{i}(x):\n    return x",
    'class K{i}:\n    r"""{x}\nclass Fake:\n"""\n    def m(self):\n        return (1,\n2)',
    "async def h{i}():\n    return [\n'}'\n]  # {x}",
    "if True:\n    def inner{i}():\n        pass",
    "x{i} = 1\n# {x}",
]


def go_content(text: Column) -> Column:
    return F.concat(F.lit("package p\n"), _lines(text, _forms(GO_FORMS)))


def py_content(text: Column) -> Column:
    return _lines(text, _forms(PY_FORMS))


def records(spark: SparkSession, sf_dir: str, content=None, extensions=None) -> DataFrame:
    """Documents as records; by default the text is shaped after the language."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang"))
    path = F.concat(
        F.lit("d"), F.col("doc_id").cast("string"),
        ext_of(F.col("doc_id"), extensions or EXTENSIONS),
    )
    docs = docs.withColumn("path", path).withColumn("language", language_of(F.col("path")))
    text, language = F.col("text"), F.col("language")
    if content is None:
        shaped = (
            F.when(language == "markdown", md_content(text))
            .when(language == "go", go_content(text))
            .when(language == "python", py_content(text))
            .otherwise(text)
        )
    else:
        shaped = content(text)
    return docs.select(
        record_id(F.col("source"), F.col("path")).alias("id"),
        F.col("source").alias("workspace_id"),
        "path",
        F.lit("").alias("symbol"),
        F.lit("").alias("symbol_type"),
        "language",
        shaped.alias("content"),
        F.lit("").alias("content_hash"),
        F.lit(None).cast(_NO_VECTOR).alias("embedding"),
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
        F.lit("upsert").alias("action"),
        F.col("doc_id").alias("seq"),
    ).withColumn("content_hash", hash_content(F.col("content")))


def old_snapshot(recs: DataFrame) -> DataFrame:
    """By number: 0 same hash, 1 another hash, 2 absent, 3 under a path no record has."""
    n = F.col("seq") % 4
    return recs.where(n != 2).select(
        "workspace_id",
        F.when(n == 3, F.concat(F.lit("gone/"), "path")).otherwise(F.col("path")).alias("path"),
        F.when(n == 1, F.sha2(F.concat("content_hash", F.lit("x")), 256))
        .otherwise(F.col("content_hash"))
        .alias("content_hash"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("updated_at"),
    )


def shape_events(events: DataFrame) -> DataFrame:
    """A change log of 'files' (users) with three symbols each; errors are deletes."""
    deleted = F.col("event_type") == "error"
    user, n = F.col("user_id"), F.col("event_id")
    path = F.concat(F.lit("u"), user.cast("string"))
    symbol = F.concat(F.lit("s"), (n % 3).cast("string"))
    vector = F.array(F.col("value").cast("float"), (user % 100).cast("float"))
    # The previous vector of a point stays when a later row has none.
    embedding = F.when(F.col("event_type") == "view", F.array().cast(_NO_VECTOR)).otherwise(vector)
    return events.select(
        F.concat_ws("#", record_id(F.lit("w"), path), symbol).alias("id"),
        F.lit("w").alias("workspace_id"),
        path.alias("path"),
        symbol.alias("symbol"),
        F.lit("section").alias("symbol_type"),
        F.lit("text").alias("language"),
        F.when(deleted, "").otherwise(F.col("event_type")).alias("content"),
        hash_content(F.col("event_type")).alias("content_hash"),
        embedding.alias("embedding"),
        F.create_map(F.lit("props"), (n % 7).cast("string")).alias("metadata"),
        F.when(deleted, "delete").otherwise("upsert").alias("action"),
        n.alias("seq"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_events(table(spark, sf_dir, "events"))


def clocked_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log without deletes, every second row of one path, numbered by nanoseconds."""
    log = change_log(spark, sf_dir).where("action <> 'delete'")
    path = F.when(F.col("seq") % 2 == 0, "hot").otherwise(F.col("path"))
    return log.withColumn("path", path).withColumn("seq", F.col("seq") * 1_000_000_007 + 1_700_000_000_000_000_000)


def event_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third user is known with the hash of 'click'."""
    users = table(spark, sf_dir, "events").where("user_id % 3 = 0").select("user_id").distinct()
    return users.select(
        F.lit("w").alias("workspace_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("path"),
        hash_content(F.lit("click")).alias("content_hash"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("updated_at"),
    )


def stored_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk rows that exist before the log: symbols s0, s1 and s9 of every second user."""
    users = table(spark, sf_dir, "events").where("user_id % 2 = 0").select("user_id").distinct()
    symbol = F.explode(F.array(F.lit("s0"), F.lit("s1"), F.lit("s9")))
    return users.select("user_id", symbol.alias("symbol")).select(
        F.lit("w").alias("workspace_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("path"),
        "symbol",
        F.lit("section").alias("symbol_type"),
        F.lit("text").alias("language"),
        F.lit("old").alias("content"),
        hash_content(F.lit("old")).alias("content_hash"),
        F.lit(None).cast(_NO_VECTOR).alias("embedding"),
        F.lit("{}").alias("metadata"),
        F.when(F.col("symbol") != "s0", F.lit(datetime(2024, 1, 1)))
        .cast("timestamp")
        .alias("created_at"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp").alias("updated_at"),
    )


def stored_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points of `stored_chunks`."""
    file_id = record_id(F.col("workspace_id"), F.col("path"))
    return stored_chunks(spark, sf_dir).select(
        F.concat_ws("#", file_id, "symbol").alias("id"),
        "workspace_id",
        "path",
        F.array(F.lit(1.0), F.lit(0.0)).cast(_NO_VECTOR).alias("vector"),
        F.lit("{}").alias("payload"),
    )


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs without scheme as object keys, with a prefix that fits, half fits or not."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    key = F.regexp_replace("url", "^https?://", "")
    host = F.substring_index(key, "/", 1)
    n = F.col("page_id") % 4
    prefix = (
        F.when(n == 0, host)
        .when(n == 1, F.concat(host, F.lit("/")))
        .when(n == 2, F.substring_index(key, ".", 1))
        .otherwise("elsewhere/")
    )
    return pages.select("page_id", key.alias("key"), prefix.alias("prefix"))


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job events: a job is a user, its first signup creates it."""
    kind = (
        F.when(F.col("event_type") == "signup", "created")
        .when(F.col("event_type") == "purchase", "done")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("status")
    )
    status = F.get(
        F.array(F.lit("running"), F.lit("done"), F.lit("failed")),
        (F.col("event_id") % 3).cast("int"),
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("j"), F.col("user_id").cast("string")).alias("job_id"),
        F.concat(F.lit("w"), (F.col("user_id") % 5).cast("string")).alias("workspace_id"),
        F.col("event_id").alias("seq"),
        "ts",
        kind.alias("kind"),
        F.when(kind == "status", status).alias("status"),
        F.when(kind == "status", F.when(status == "failed", F.col("props")).otherwise(""))
        .alias("error_msg"),
        F.when(kind == "created", F.col("user_id") % 10).alias("total_files"),
    )
