"""Top-level Go declarations as an array expression over one file.

Literals and comments are masked in place, then lines are joined into bracket-balanced
statements with Go's automatic semicolon rule.  Contents are whole source lines.  A file
without a package clause, with unbalanced brackets, with an unterminated literal, or with
anything but declarations at the top level counts as unparsable and gives no chunk.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.statements import (
    INNER_BREAK,
    count_of,
    mask,
    newlines,
    statement_groups,
)
from chunkloom.functions.text import by_bytes, let

# Possessive quantifiers keep the matcher from recursing on long literals.
_TOKEN = (
    r"`[^`]*+`"
    r"|//[^\n]*+"
    r"|/\*[\s\S]*?\*/"
    r'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
    r"""|[^`/"']++"""
    r"|[\s\S]"
)
_ID = r"[\p{L}_][\p{L}\p{N}_]*+"
_WORD_END = r"(?![\p{L}\p{N}_])"
# Keywords after which a line break does not end the statement.
_OPEN_KEYWORDS = "var|const|type|import|func|chan|map|struct|interface|package"
_BROKEN = "\x01"  # stands for a quote that opens no literal
_CHUNKS = "array<struct<symbol:string,symbol_type:string,content:string>>"


def _masked(token: Column) -> Column:
    """A literal becomes a quoted gap and a comment white space; both keep their lines."""
    quote = F.left(token, F.lit(1)).isin('"', "`", "'")
    comment = F.startswith(token, F.lit("//")) | (
        F.startswith(token, F.lit("/*")) & (F.length(token) > 1)
    )
    spans_lines = F.contains(token, F.lit("\n"))
    breaks = count_of(token, "\n")
    literal = F.concat(F.lit('"'), F.repeat(F.lit(INNER_BREAK), breaks), F.lit('"'))
    return (
        F.when(comment, F.when(spans_lines, F.repeat(F.lit("\n"), breaks)).otherwise(" "))
        .when(quote & (F.length(token) > 1), F.when(spans_lines, literal).otherwise('"'))
        .when(quote, F.lit(_BROKEN))
        .otherwise(token)
    )


def _ends_statement(line: Column) -> Column:
    """A line ends a statement after a word, a literal, a closing bracket or a semicolon.

    Of the keywords only those that end a statement by themselves count as words.
    """
    return F.substring(line, -12, 12).rlike(
        rf'[\p{{L}}\p{{N}}_"\)\]}};](?<!(?:^|[^\p{{L}}\p{{N}}_])(?:{_OPEN_KEYWORDS}))$'
    )


def _lines_between(lines: Column, first: Column, text: Column) -> Column:
    """Whole source lines touched by the significant part of ``text``."""
    count = newlines(F.rtrim(text, F.lit(" \t\r\n;"))) + 1
    return F.array_join(F.slice(lines, first + 1, count), "\n")


def _chunk(symbol: Column, kind, content: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(
        symbol.alias("symbol"), kind.alias("symbol_type"), content.alias("content")
    )


def _func_chunk(decl: Column, lines: Column) -> Column:
    def name_and_kind(head):
        receiver = F.regexp_extract(
            head, rf"^\s*func\s*\(\s*(?:{_ID}(?:\s+|(?=\*)))?\*?\s*({_ID})\s*,?\s*\)", 1
        )
        method = F.regexp_extract(
            head, rf"^\s*func\s*\((?:[^()]|\([^()]*+\))++\)\s*({_ID})", 1
        )
        plain = F.regexp_extract(head, rf"^\s*func\s*(?:\(\s*\)\s*)?({_ID})", 1)
        is_method = head.rlike(r"^\s*func\s*\(\s*[^\s)]")
        of_type = let(
            receiver, lambda r: F.when(r == "", method).otherwise(F.concat_ws(".", r, method))
        )
        return F.when(
            is_method, F.struct(of_type.alias("symbol"), F.lit("method").alias("kind"))
        ).otherwise(F.struct(plain.alias("symbol"), F.lit("func").alias("kind")))

    # Receiver and name stand before the first brace.
    return let(
        let(F.substring_index(decl.text, "{", 1), name_and_kind),
        lambda f: _chunk(f.symbol, f.kind, _lines_between(lines, decl.pos, decl.text)),
    )


def _specs(decl: Column, keyword: Column, use) -> Column:
    """``use(array<struct<text, pos>>)`` of the specs of a type, var or const declaration."""
    head = F.regexp_extract(decl.text, rf"^\s*(?:type|var|const)\s*(?:\(|(?=[^\s(]))", 0)
    grouped = F.endswith(head, F.lit("("))
    rest = F.substr(decl.text, F.length(head) + 1)
    inner = F.regexp_replace(rest, r"\)[\s;]*+$", "")
    line = decl.pos + newlines(head)
    single = F.array(F.struct(rest.alias("text"), line.alias("pos")))
    pieces = F.split(inner, r"(?<=[\n;])", -1)

    def moved(groups, _balanced):
        return F.transform(
            groups, lambda g: F.struct(g.text.alias("text"), (g.pos + line).alias("pos"))
        )

    many = statement_groups(pieces, newlines, _ends_statement, moved)
    return let(F.when(grouped, many).otherwise(single), use)


def _gen_chunks(decl: Column, keyword: Column, lines: Column) -> Column:
    def of_spec(spec):
        content = _lines_between(lines, spec.pos, spec.text)
        names = F.when(
            keyword == "type", F.regexp_extract(spec.text, rf"^\s*({_ID})", 1)
        ).otherwise(F.regexp_extract(spec.text, rf"^\s*({_ID}(?:\s*,\s*{_ID})*+)", 1))
        return F.transform(
            F.split(names, r"\s*,\s*", -1), lambda name: _chunk(name, keyword, content)
        )

    return _specs(decl, keyword, lambda specs: F.flatten(F.transform(specs, of_spec)))


def go_chunks(content: Column) -> Column:
    """``array<struct<symbol, symbol_type, content>>`` in source order."""

    def declarations(text, original):
        def chunks(lines, groups, balanced, broken):
            nothing = F.array().cast(_CHUNKS)

            def of_decl(decl):
                word = F.regexp_extract(decl.text, rf"^\s*(func|type|var|const){_WORD_END}", 1)
                return let(
                    word,
                    lambda kw: F.when(kw == "func", F.array(_func_chunk(decl, lines)))
                    .when(kw != "", _gen_chunks(decl, kw, lines))
                    .otherwise(nothing),
                )

            clause = F.coalesce(F.get(groups, F.lit(0)).text, F.lit(""))
            parses = (
                balanced
                & ~broken
                & clause.rlike(rf"^\uFEFF?\s*package\s+{_ID}[\s;]*+$")
                & F.forall(
                    F.slice(groups, 2, F.greatest(F.size(groups) - 1, F.lit(0))),
                    lambda g: g.text.rlike(rf"^\s*(?:func|type|var|const|import){_WORD_END}"),
                )
            )
            found = F.flatten(F.transform(groups, of_decl))
            back = F.transform(
                found,
                lambda c: _chunk(original(c.symbol), c.symbol_type, original(c.content)),
            )
            return F.when(parses, back).otherwise(nothing)

        def from_masked(masked):
            broken = F.contains(masked, F.lit(_BROKEN)) | F.contains(masked, F.lit("/*"))
            return statement_groups(
                F.split(masked, r"(?<=[\n;])", -1),
                newlines,
                _ends_statement,
                lambda groups, balanced: let(
                    F.split(text, "\n", -1), lambda lines: chunks(lines, groups, balanced, broken)
                ),
            )

        return let(mask(text, _TOKEN, _masked), from_masked)

    return by_bytes(content, declarations)
