"""URL filter: longest rule first, gradient-boosted trees on lexical features for the rest.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the
end. A null url or one without ``://`` has both empty. A rule fits its host and all subdomains where the path starts
with the rule's; the longest fitting rule decides. Urls that a rule decides are the labels; trees are
fitted on at most ``train_rows`` of them, the first by a hash of the url, and judge the urls no rule fits.

Features: lengths, depth, digit ratio, entropy of the characters, parameter counts, and statistics of host
suffixes and of the first path segment: share of blocked urls among labelled ones, smoothed by the share of all. A labelled
row sees only the labels outside its own fold, one of ``FOLDS`` by a hash of the url, so neither its label nor that of a
copy is among its features; a row without a label sees all of them. Statistics tables are joined, not
broadcast by force.

With no labelled url the verdict is ``fallback``; with one class only it is that class. Rows are independent:
null, empty and repeated urls each get a row.
"""

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.stage import Stage

TRAIN_ROWS = 10_000
FOLDS = 5
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "digits", "entropy", "parameters",
    "hyphens", "labels", "fragment", "suffix_share", "segment_share",
]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; rules are (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, at, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, over the 96 printable ones; others count as one more."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    text = F.regexp_replace(text, "[^ -~]", "\x7f")
    seen = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    shares = F.transform(
        seen, lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    )
    return F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _with_share(rows: DataFrame, key: str, name: str, prior: float) -> DataFrame:
    """``rows`` with the smoothed share of blocked ones among the labelled rows of their key, outside the own fold."""
    folds = rows.where("label IS NOT NULL").groupBy(key, "fold").agg(
        F.count("*").alias("n"), F.sum("label").alias("blocked")
    )
    # at most FOLDS entries a key
    keys = folds.groupBy(key).agg(
        F.sum("n").alias("_n"),
        F.sum("blocked").alias("_blocked"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "blocked")))).alias("_folds"),
    )
    own = F.when(F.col("label").isNotNull(), F.col("_folds")[F.col("fold")])
    n = F.col("_n") - F.coalesce(own["n"], F.lit(0))
    blocked = F.col("_blocked") - F.coalesce(own["blocked"], F.lit(0.0))
    share = (blocked + 2 * prior) / (n + 2)
    joined = rows.join(keys, key, "left").withColumn(name, F.coalesce(share, F.lit(prior)))
    return joined.drop("_n", "_blocked", "_folds")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def fitted(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    train_rows: int = TRAIN_ROWS,
    fallback: str = "allow",
    trees: int = 10,
    id_col: str = "page_id",
    url_col: str = "url",
):
    """(rows with ``FEATURES``, the trees, None), or (rows without shares, None, the one verdict) if labels do not differ."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    text = F.coalesce("url", F.lit(""))
    rows = rows.withColumns(
        {
            "label": F.when(F.col("said") == "block", 1.0).when(F.col("said") == "allow", 0.0),
            "suffix": _suffix(F.col("host")),
            "segment": F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit("")),
            "url_length": F.length(text).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": _count(F.col("path"), "/[^/]"),
            "digits": _count(text, "[0-9]") / F.greatest(F.length(text), F.lit(1)),
            "entropy": _entropy(text),
            "parameters": _count(text, "[?&][^?&#=]*="),
            "hyphens": _count(F.col("host"), "-"),
            "labels": _count(F.col("host"), "[.]"),
            "fragment": F.contains(text, F.lit("#")).cast("double"),
            "order": F.xxhash64("url"),
            "fold": F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)),
        }
    )
    rows = Stage(pages.sparkSession).table(rows.drop("url"), "urls")
    labelled = rows.where("label IS NOT NULL")
    total = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).first()
    if not total["n"] or total["blocked"] in (0.0, float(total["n"])):
        said = fallback if not total["n"] else "block" if total["blocked"] else "allow"
        return rows, None, said
    prior = total["blocked"] / total["n"]
    for key, name in (("suffix", "suffix_share"), ("segment", "segment_share")):
        rows = _with_share(rows, key, name, prior)
    train = (
        rows.where("label IS NOT NULL")
        .select(*FEATURES, "label", "order")
        .orderBy("order", *FEATURES)
        .limit(train_rows)
    )
    model = GBTClassifier(maxIter=trees, maxDepth=4, seed=7, labelCol="label").fit(
        _assembled(train).select("features", "label")
    )
    return rows, model, None


def url_filter(pages: DataFrame, rules: list[tuple[str, str, str]], **options) -> DataFrame:
    """Per row: ``id``, ``host``, ``path``, ``rule``, ``verdict`` and ``p_block`` of the trees (null: none fitted).

    Options are those of ``fitted``.
    """
    rows, model, said = fitted(pages, rules, **options)
    out = ["id", "host", "path", "rule"]
    if model is None:
        return rows.select(
            *out, F.coalesce("said", F.lit(said)).alias("verdict"), F.lit(None).cast("double").alias("p_block")
        )
    judged = model.transform(_assembled(rows.drop("label")))
    p = F.get(vector_to_array("probability"), F.lit(1))
    return judged.select(
        *out,
        F.coalesce("said", F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"),
        p.alias("p_block"),
    )
