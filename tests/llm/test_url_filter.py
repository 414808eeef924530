"""Features and verdicts of the trees against plain loops."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors

from chunkloom.llm.url_filter import FEATURES, fitted, url_filter

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "net", "/es/"), ("block", "org", "/ads/")]


def urls():
    rng = random.Random(3)
    hosts = ["a.com", "www.example.com", "x.net", "b-c.net", "q.org", "r.info", "é.io", "EXAMPLE.com"]
    for i in range(600):
        host, segment = rng.choice(hosts), rng.choice(["en", "es", "ads", "fr", f"only{i}"])
        tail = rng.choice(["", "?a=1&b=2", "#top", "/deep/er?x=", "/漢字漢", "/1234"])
        yield f"http://{host}/{segment}/{rng.randrange(50)}{tail}"
    yield from [None, "", "no scheme", "://", "http://r.info/" + "a1" * 3000]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.replace("EXAMPLE", "example"), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = [r for r in RULES if ("." + host).endswith("." + r[1]) and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


def lexical(url, host, path):
    text = url or ""
    n = max(len(text), 1)
    seen = Counter(c if " " <= c <= "~" else "other" for c in text)
    return {
        "url_length": len(text), "host_length": len(host), "path_length": len(path),
        "depth": len(re.findall("/[^/]", path)), "digits": len(re.findall("[0-9]", text)) / n,
        "entropy": -sum(k / n * math.log2(k / n) for k in seen.values()),
        "parameters": len(re.findall("[?&][^?&#=]*=", text)), "hyphens": host.count("-"),
        "labels": host.count("."), "fragment": "#" in text,
    }


def test_trees_against_plain_scorer(spark):
    plain = []
    for i, url in enumerate(urls()):
        host, path = split(url)
        rule = rule_of(host, path)
        suffix, segment = ".".join(host.split(".")[-2:]), (path.split("/") + [""])[1]
        plain.append((i, url, host, path, rule, suffix, segment))
    table = spark.createDataFrame([p[:2] for p in plain], "page_id long, url string")
    rows, model, said = fitted(table, RULES)
    assert said is None
    features = {r.id: r for r in rows.collect()}
    verdicts = {r.id: r for r in url_filter(table, RULES).collect()}
    marks = [(p[5], p[6], p[4][0] == "block") for p in plain if p[4]]
    prior = sum(m[2] for m in marks) / len(marks)
    unruled = 0
    for i, url, host, path, rule, suffix, segment in plain:
        got = features[i]
        for name, value in lexical(url, host, path).items():
            assert got[name] == pytest.approx(float(value), abs=1e-9), (name, url)
        if rule:
            assert verdicts[i].verdict == rule[0] and verdicts[i].rule == rule[1] + rule[2]
            if segment.startswith("only"):  # no other url has it, and the own label is not counted
                assert got.segment_share == pytest.approx(prior)
            continue
        unruled += 1
        for name, at, key in (("suffix_share", 0, suffix), ("segment_share", 1, segment)):
            same = [m[2] for m in marks if m[at] == key]
            assert got[name] == pytest.approx((sum(same) + 2 * prior) / (len(same) + 2))
        p = model.predictProbability(Vectors.dense([got[f] for f in FEATURES]))[1]
        assert verdicts[i].p_block == pytest.approx(p)
        assert verdicts[i].verdict == ("block" if p >= 0.5 else "allow") and verdicts[i].rule is None
    assert unruled > 100 and {v.verdict for i, v in verdicts.items() if plain[i][4] is None} == {"allow", "block"}
