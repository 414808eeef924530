"""Markdown sections as an array expression: no shuffle and no Python worker.

A heading is any line that starts with ``#`` in column 0 (any count, no space needed, code
fences ignored).  The heading line is not part of the body, every body line is written back
with a newline, text before the first heading is ``_intro``, and a blank section vanishes.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.text import by_bytes, is_blank, trim_space


def markdown_chunks(content: Column) -> Column:
    """``array<struct<symbol, symbol_type, content>>`` of the non-blank sections."""

    def sections(text, original):
        # Every line of the text plus one newline ends in a newline, the last one too.
        pieces = F.split(F.concat(text, F.lit("\n")), r"(?<=\n)(?=#)", -1)

        def section(piece):
            headed = F.startswith(piece, F.lit("#"))
            line = F.substring_index(piece, "\n", 1)
            heading = trim_space(original(F.ltrim(line, F.lit("#"))))
            body = F.when(headed, F.substr(piece, F.length(line) + 2)).otherwise(piece)
            return F.struct(
                F.when(headed, heading).otherwise("_intro").alias("symbol"),
                F.lit("section").alias("symbol_type"),
                original(body).alias("content"),
            )

        return F.filter(F.transform(pieces, section), lambda s: ~is_blank(s.content))

    return by_bytes(content, sections)
