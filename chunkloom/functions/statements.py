"""Grouping of masked source lines into statements, as array expressions inside one row."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom.functions.text import let

_STARTS = "array<struct<i:int,pos:int>>"
# Pieces folded into one small list of starts, before that list joins the others.
_BLOCK = 256


# Stands for a line break inside a literal, which ends no statement.
INNER_BREAK = "\x02"


def count_of(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def newlines(text: Column) -> Column:
    """Line breaks in a masked text."""
    inner = F.when(F.contains(text, F.lit(INNER_BREAK)), count_of(text, INNER_BREAK))
    return count_of(text, "\n") + inner.otherwise(0)


def bracket_balance(text: Column) -> Column:
    """Opening minus closing brackets."""
    brackets = F.regexp_replace(text, r"[^()\[\]{}]++", "")
    return let(
        brackets,
        lambda b: F.when(b == "", 0).otherwise(
            2 * F.length(F.regexp_replace(b, r"[)\]}]++", "")) - F.length(b)
        ),
    )


def mask(text: Column, token_pattern: str, masked: Callable[[Column], Column]) -> Column:
    """Put ``masked(token)`` in the place of every token."""
    tokens = F.regexp_extract_all(text, F.lit(token_pattern), F.lit(0))
    return F.array_join(F.transform(tokens, masked), "")


def statement_groups(
    pieces: Column,
    measure: Callable[[Column], Column],
    ends: Callable[[Column], Column],
    done: Callable[[Column, Column], Column],
) -> Column:
    """Join consecutive pieces that belong to one bracket-balanced statement.

    A non-blank piece opens a statement when no bracket is open and the last non-blank piece
    before it ``ends`` one.  ``done(groups, balanced)`` gets ``array<struct<text, pos>>``, where
    ``pos`` sums ``measure`` over all earlier pieces, and whether the brackets matched.
    Only the start of each statement is kept while folding.  An append copies its list, so starts
    are gathered block by block: a list holds one block, and the list of lists grows once a block.
    """
    none = F.array().cast(_STARTS)
    first = F.struct(
        F.lit(0).alias("i"),
        F.lit(0).alias("pos"),
        F.lit(0).alias("depth"),
        F.lit(";").alias("last"),
        F.lit(True).alias("balanced"),
        F.array().cast(f"array<{_STARTS}>").alias("starts"),
    )
    carried = ["i", "pos", "depth", "last", "balanced"]

    def fold_block(state, block):
        opened = F.struct(*[state[c].alias(c) for c in carried], none.alias("starts"))
        return let(
            F.aggregate(block, opened, step),
            lambda inner: F.struct(
                *[inner[c].alias(c) for c in carried],
                F.array_append(state.starts, inner.starts).alias("starts"),
            ),
        )

    def blocks(parts):
        count = F.ceil(F.size(parts) / _BLOCK).cast("int")
        numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(numbers, lambda b: F.slice(parts, b * _BLOCK + 1, F.lit(_BLOCK)))

    def step(state, piece):
        core = F.btrim(piece, F.lit(" \t\r\n"))
        start = F.struct(state.i.alias("i"), state.pos.alias("pos"))
        opens = (state.depth == 0) & (core != "") & ends(state.last)
        # Lines inside brackets neither open nor end a statement and are not trimmed.
        return let(
            state.depth + bracket_balance(piece),
            lambda depth: F.struct(
                (state.i + 1).alias("i"),
                (state.pos + measure(piece)).alias("pos"),
                F.greatest(depth, F.lit(0)).alias("depth"),
                F.when((depth <= 0) & (core != ""), core).otherwise(state.last).alias("last"),
                (state.balanced & (depth >= 0)).alias("balanced"),
                F.when(opens, F.array_append(state.starts, start))
                .otherwise(state.starts)
                .alias("starts"),
            ),
        )

    def groups(parts, state):
        def texts(starts):
            def text_of(start, k):
                following = F.coalesce(F.get(starts, k + 1).i, F.size(parts))
                lines = F.slice(parts, start.i + 1, following - start.i)
                return F.struct(F.array_join(lines, "").alias("text"), start.pos.alias("pos"))

            return F.transform(starts, text_of)

        return let(
            let(F.flatten(state.starts), texts),
            lambda g: done(g, state.balanced & (state.depth == 0)),
        )

    return let(
        pieces,
        lambda parts: let(
            F.aggregate(blocks(parts), first, fold_block), lambda state: groups(parts, state)
        ),
    )
