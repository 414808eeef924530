"""Chunk expressions on edge texts, with results worked out by hand or by another parser."""

import ast
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkloom.operators.fanout import fan_out, symbol_collisions
from chunkloom.operators.go_symbols import go_chunks
from chunkloom.operators.markdown import markdown_chunks
from chunkloom.operators.python_symbols import python_chunks
from chunkloom.schema import RECORDS


def chunks(spark, chunker, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = rows.select("i", chunker(F.col("t")).alias("c")).orderBy("i").collect()
    return [[tuple(c) for c in r.c] for r in found]


def sections(spark, *texts):
    return [[(c[0], c[2]) for c in found] for found in chunks(spark, markdown_chunks, *texts)]


MARKDOWN = {
    "# A\nb\n": [("A", "b\n\n")],
    "x\n# A\n\n## B ##\nc": [("_intro", "x\n"), ("B ##", "c\n")],
    "#\nq\n#A\n \n": [("", "q\n")],
    "no head": [("_intro", "no head\n")],
    "": [],
    "#only\n##x": [],
    "a\r\n# H\r\nb\r\n": [("_intro", "a\r\n"), ("H", "b\r\n\n")],
    "#　T \nz\n# k\n \n": [("T", "z\n")],
    "```\n#include\n```": [("_intro", "```\n"), ("include", "```\n")],
    " # indented\nt": [("_intro", " # indented\nt\n")],
    "a # no\nb": [("_intro", "a # no\nb\n")],
}


def test_markdown_edges(spark):
    assert sections(spark, *MARKDOWN) == list(MARKDOWN.values())


def split_by_line(text):
    """The section rule line by line."""
    space = " \t\n\v\f\r\x85\xa0     　" + "".join(
        map(chr, range(0x2000, 0x200B))
    )
    found, symbol, body = [], "_intro", ""
    for line in [*text.split("\n"), "#"]:
        if not line.startswith("#"):
            body += line + "\n"
            continue
        if body.strip(space):
            found.append((symbol, body))
        symbol, body = line.lstrip("#").strip(space), ""
    return found


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.lists(
            st.sampled_from(["#", "\n", " ", "a", "\t", "\r", " ", "é", "##\n", "\x1c", "😀"]),
            max_size=30,
        ).map("".join),
        min_size=40,
        max_size=40,
    )
)
def test_markdown_equals_line_loop(spark, texts):
    assert sections(spark, *texts) == [split_by_line(t) for t in texts]


GO = """// c
package p

import (
\t"fmt"
)

func F[T any](a int) string {
\tx := "}{" // {
\tvar y = 1
\treturn `
func fake() {
`
}

func (r *T) M() {}
func (T) V() {}
func (r G[K]) N() { /* } */ }
type (
\tS struct {
\t\ta int // }
\t}
\tI interface{}
)
type A = int
const (
\tX, Y = 1, 2
\tE = 1 +
\t\t2; Q = 3
\tZ
)
var f =
\tfunc() int { return '{' }
/* doc
 */ var g, h = 1, 2 // end
var
  k int
var R = `
func fake() {
`
func (*P) W(
\ta int,
) {
}
"""


def test_go_symbols(spark):
    found = chunks(spark, go_chunks, GO)[0]
    assert found == [
        (
            "F",
            "func",
            'func F[T any](a int) string {\n\tx := "}{" // {\n\tvar y = 1\n\treturn `\n'
            "func fake() {\n`\n}",
        ),
        ("T.M", "method", "func (r *T) M() {}"),
        ("T.V", "method", "func (T) V() {}"),
        ("N", "method", "func (r G[K]) N() { /* } */ }"),
        ("S", "type", "\tS struct {\n\t\ta int // }\n\t}"),
        ("I", "type", "\tI interface{}"),
        ("A", "type", "type A = int"),
        ("X", "const", "\tX, Y = 1, 2"),
        ("Y", "const", "\tX, Y = 1, 2"),
        ("E", "const", "\tE = 1 +\n\t\t2; Q = 3"),
        ("Q", "const", "\t\t2; Q = 3"),
        ("Z", "const", "\tZ"),
        ("f", "var", "var f =\n\tfunc() int { return '{' }"),
        ("g", "var", " */ var g, h = 1, 2 // end"),
        ("h", "var", " */ var g, h = 1, 2 // end"),
        ("k", "var", "  k int"),
        ("R", "var", "var R = `\nfunc fake() {\n`"),
        ("P.W", "method", "func (*P) W(\n\ta int,\n) {\n}"),
    ]


@pytest.mark.parametrize(
    "text",
    [
        "",
        "package p\n",
        'package p\nimport "x"\n',
        "func f(){}\n",
        "package p\nfunc f() {\n",
        "package p\nfunc f() {}}\n",
        "package p\nx := 1\n",
        'package p\nvar s = "abc\n',
        "package p\nvar s = `abc\n",
        "package p\n/* open\nvar a = 1\n",
    ],
)
def test_go_without_chunks(spark, text):
    assert chunks(spark, go_chunks, text) == [[]]


def test_go_long_literal_and_many_lines(spark):
    big = 'package p\nvar b = "' + "\\x00" * 50_000 + '"\n'
    many = "package p\nconst (\n" + "".join(f"\tC{i} = {i}\n" for i in range(5_000)) + ")\n"
    first, second = chunks(spark, go_chunks, big, many)
    assert [c[0] for c in first] == ["b"] and len(first[0][2]) > 200_000
    assert [c[0] for c in second] == [f"C{i}" for i in range(5_000)]


PYTHON = '''import os
x = [
1,
]
@deco
def skip():
    pass

def f(a,
b):
    """
class Fake:
"""
    return 1  # same
    # tail

    # tail2
  # shallow
# top
async def g(): pass  # one
    # after
if x:
    def inner(): pass
class K(object):
    def m(self):
        return (
1)


class One: pass
def last():
    return "a\\
b" \\
+ '\\''
'''


def test_python_symbols(spark):
    assert chunks(spark, python_chunks, PYTHON)[0] == [
        (
            "f",
            "func",
            'def f(a,\nb):\n    """\nclass Fake:\n"""\n    return 1  # same\n'
            "    # tail\n\n    # tail2",
        ),
        ("g", "func", "async def g(): pass  # one"),
        ("K", "class", "class K(object):\n    def m(self):\n        return (\n1)"),
        ("One", "class", "class One: pass"),
        ("last", "func", "def last():\n    return \"a\\\nb\" \\\n+ '\\''"),
    ]
    assert chunks(spark, python_chunks, "x = 1\n", "") == [[], []]


def test_python_equals_ast_on_library_files(spark):
    """Names and source of undecorated top-level definitions in real files."""
    modules = [ast, hashlib, pytest]
    import argparse
    import collections
    import dataclasses
    import textwrap

    modules += [argparse, collections, dataclasses, textwrap]
    texts = [open(m.__file__, encoding="utf-8").read() for m in modules]
    for text, found in zip(texts, chunks(spark, python_chunks, *texts), strict=True):
        wanted = []
        for node in ast.parse(text).body:
            kinds = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)
            if isinstance(node, kinds) and not node.decorator_list:
                kind = "class" if isinstance(node, ast.ClassDef) else "func"
                wanted.append((node.name, kind, ast.get_source_segment(text, node)))
        assert [c[:2] for c in found] == [w[:2] for w in wanted]
        for have, want in zip(found, wanted, strict=True):
            # A chunk may go on with comments of its last block.
            assert have[2].startswith(want[2])
            rest = have[2][len(want[2]) :].strip().splitlines()
            assert all(line.strip() == "" or line.strip().startswith("#") for line in rest)


def test_bytes_that_are_no_utf8_survive(spark):
    raw = b"# \xff \n\xe9 body\n"
    rows = spark.createDataFrame([(bytearray(raw),)], "b binary")
    text = rows.select(F.col("b").cast("string").alias("t"))
    chunk = text.select(F.explode(markdown_chunks(F.col("t"))).alias("c")).select(
        F.col("c.symbol").cast("binary").alias("s"), F.sha2("c.content", 256).alias("h")
    )
    symbol, digest = chunk.first()
    assert bytes(symbol) == b"\xff"
    assert digest == hashlib.sha256(b"\xe9 body\n\n").hexdigest()


def record(**values):
    base = dict.fromkeys(RECORDS.names)
    base |= {"symbol": "", "symbol_type": "", "action": "upsert", "seq": 1, "workspace_id": "w"}
    base |= {"id": "f", "path": "p", "content_hash": "h", **values}
    return tuple(base[n] for n in RECORDS.names)


def test_fan_out_branches(spark):
    rows = spark.createDataFrame(
        [
            record(id="a", language="markdown", content="# x\ny", metadata=None),
            record(id="b", language="markdown", content="#x", embedding=[1.0], metadata={"k": "v"}),
            record(id="c", language="markdown", content="# x\ny", action="delete"),
            record(id="d", language="rust", content="fn", embedding=[2.0]),
            record(id="e", language="go", content="broken"),
            record(id="g", language="python", content="def a():\n  1\n", metadata={"k": "v"}),
        ],
        RECORDS,
    )
    found = {r["file_id"]: r.asDict() for r in fan_out(rows).collect()}
    assert found["a"]["id"] == "a#x" and found["a"]["metadata"] == {}
    assert found["a"]["content_hash"] == hashlib.sha256(b"y\n").hexdigest()
    assert found["b"]["id"] == "b" and found["b"]["symbol"] == "_doc"
    assert found["b"]["embedding"] == [1.0] and found["b"]["metadata"] == {"k": "v"}
    assert found["b"]["content_hash"] == hashlib.sha256(b"#x").hexdigest()
    assert found["c"]["action"] == "delete" and found["c"]["content_hash"] == "h"
    assert found["d"]["origin"] == "pass" and found["d"]["embedding"] == [2.0]
    assert found["e"]["symbol"] == "_file" and found["e"]["symbol_type"] == "file"
    assert found["g"]["id"] == "g#a" and found["g"]["embedding"] is None


def test_repeated_symbols_are_reported(spark):
    rows = spark.createDataFrame(
        [record(id="a", language="markdown", content="# x\ny\n# x\nz\n# w\nv")], RECORDS
    )
    assert [tuple(r) for r in symbol_collisions(fan_out(rows)).collect()] == [("w", "p", "x", 2)]
