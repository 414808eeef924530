"""Top-level Python functions and classes as an array expression over one file.

Only undecorated ``def``, ``async def`` and ``class`` statements in column 0 count; a class is
one chunk with all its methods.  A chunk ends with its last token; a comment on the same line
or, below that, at least as deep as the body still belongs to it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.statements import mask, statement_groups
from chunkloom.functions.text import by_bytes, let

_TOKEN = (
    r'"{3}[^"\\]*+(?:(?:\\[\s\S]|"(?!""))[^"\\]*+)*+"{3}'
    r"|'{3}[^'\\]*+(?:(?:\\[\s\S]|'(?!''))[^'\\]*+)*+'{3}"
    r'|"[^"\\\n]*+(?:\\[\s\S][^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\[\s\S][^'\\\n]*+)*+'"
    r"|#[^\n]*+"
    r"|\\\r?\n"
    r"""|[^"'#\\]++"""
    r"|[\s\S]"
)
_ID = r"[\p{L}_][\p{L}\p{N}_]*+"
_DEFINITION = rf"^(?:(?:async[ \t]+)?def|class)[ \t]+({_ID})"


def _masked(token: Column) -> Column:
    quote = F.left(token, F.lit(1)).isin('"', "'") & (F.length(token) > 1)
    joined = F.startswith(token, F.lit("\\")) & (F.length(token) > 1)
    filler = (
        F.when(quote, F.lit('"'))
        .when(F.startswith(token, F.lit("#")), F.lit("#"))
        .when(joined, F.lit(" "))
    )
    return F.when(filler.isNull(), token).otherwise(F.repeat(filler, F.length(token)))


def _length_of_definition(text: Column) -> Column:
    core = F.length(F.rtrim(text, F.lit(" \t\r\n\f#")))
    tail = F.substr(text, core + 1)
    indent = F.length(
        F.regexp_extract(
            text, r":[ \t]*#*[ \t\r]*\n(?:[ \t]*#*[ \t\r]*\n)*+([ \t]+)[^\s#]", 1
        )
    )
    deep = F.when(indent > 0, indent).otherwise(F.lit(100000))
    pattern = F.concat(
        F.lit(r"^(?:[ \t]*#+)?(?:[ \t\r\n]*\n[ \t]{"), deep.cast("string"), F.lit(r",}#+)*+")
    )
    return core + F.length(F.regexp_extract_all(tail, pattern, F.lit(0))[0])


def python_chunks(content: Column) -> Column:
    """``array<struct<symbol, symbol_type, content>>`` in source order."""

    def definitions(text, original):
        def chunks(groups, _balanced):
            def with_previous(group, k):
                previous = F.coalesce(F.get(groups, k - 1).text, F.lit(""))
                return F.struct(
                    group.text.alias("text"),
                    group.pos.alias("pos"),
                    F.startswith(previous, F.lit("@")).alias("decorated"),
                    F.regexp_extract(group.text, _DEFINITION, 1).alias("name"),
                )

            def chunk(d):
                kind = F.when(F.startswith(d.text, F.lit("class")), "class").otherwise("func")
                body = F.substr(text, d.pos + 1, _length_of_definition(d.text))
                return F.struct(
                    original(d["name"]).alias("symbol"),
                    kind.alias("symbol_type"),
                    original(body).alias("content"),
                )

            found = F.filter(
                F.transform(groups, with_previous), lambda d: ~d.decorated & (d["name"] != "")
            )
            return F.transform(found, chunk)

        # A statement begins with a character in column 0 that opens no comment.
        return let(
            mask(text, _TOKEN, _masked),
            lambda masked: statement_groups(
                F.split(masked, r"(?<=\n)(?=[^\s#])", -1),
                F.length,
                lambda _piece: F.lit(True),
                chunks,
            ),
        )

    return by_bytes(content, definitions)
