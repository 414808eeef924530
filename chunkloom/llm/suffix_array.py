"""Repeated strings by a depth-limited radix sort of suffixes, most significant digit first.

Every element of every text, a byte or a word (``Unit``), starts a suffix; suffixes are ordered only through their first
``length`` elements, never across documents. After the last pass equal groups are exactly the repeated windows. A
pass groups suffixes by a further digit of their prefix and drops what is alone, so later passes see only what may
still repeat. Neighbouring suffixes share most of their elements, so one row stands for a range of them and its key is the
prefix of the range's last suffix, as far as every suffix of the range reaches in the depth of the pass:

* Ranges of some hundred suffixes: those whose first ``length`` elements hold the same smallest hashed gram, which
  is the first digit of the suffix that starts with it. A range whose digit is alone is done. Ranges equal in all
  that their suffixes span repeat as a whole, however many they are, and go on with one representative.
* Ranges of ``radix`` neighbours, cut at fixed distances from the gram. ``DIGITS`` passes read one more part of the
  prefix each and drop the groups of one. Ranges equal as a whole again go on with one representative.
* Single suffixes through the full length.

The second and third see only the neighbourhood of places where copies differ. By default every element that a repeated
window covers is found, at all places; with ``keep_first`` the window's first place (by id, text hash and position) is
left out. Null and short texts have no windows. Rows that repeat id and text are copies of each other. Equality of
ranges and suffixes is equality of 128-bit hashes.

Several units go through the same passes, each row with the number ``u`` of its unit. That number is part of the first
digit, so rows of different units share no group; texts are brought to the ranges of all units at once.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.numeric import (
    BLOCK_BYTES,
    U,
    Sequence,
    bytes_sequence,
    merge_spans,
    minimizer_runs,
    mix,
    signed,
    spread_ranges,
    text_blocks,
    word_hashes,
    words,
)
from chunkloom.llm.spans import range_arrays, with_ranges
from chunkloom.llm.stage import Stage, keyed


@dataclass(frozen=True)
class Unit:
    """What a text is a sequence of, and how far suffixes are ordered."""

    name: str
    length: int
    gram: int
    radix: int


BYTES = Unit("bytes", 400, 160, 16)
WORDS = Unit("words", 50, 13, 4)
DIGITS = 3
_SEGMENT = 4 << 20
_PART_BYTES = BLOCK_BYTES // 4
_RUN = "id {}, h long, u int, a long, c1 long, c2 long, lo int, n int, g int"
_PART = "id {}, h long, u int, d1 long, d2 long, d3 long, w1 long, w2 long, lo int, n int"
_SUFFIX = "id {}, h long, u int, w1 long, w2 long, lo int"
_RESULT = (
    "id {}, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary, n_repeated_words long"
)


@dataclass
class _Piece:
    """Elements of a block of texts, or of a segment of a huge one: where each text starts, ``shift`` before it."""

    first: int  # row of the first text
    offsets: np.ndarray
    shift: int
    limit: int  # suffixes from here on belong to the next segment
    sequence: object  # of a hash family

    @property
    def size(self) -> int:
        return int(self.offsets[-1])


def _pieces(column: pa.Array, unit: Unit, block: int = BLOCK_BYTES):
    for first, _, buf, offsets in text_blocks(column, block):
        if unit.name == "words":
            starts, ends, text = words(buf, offsets)
            marks = np.searchsorted(text, np.arange(len(offsets)))

            def of(family, buf=buf, starts=starts, ends=ends):
                return Sequence(word_hashes(buf, starts, ends, family), family)

            yield _Piece(first, marks, 0, len(starts), of)
        elif len(buf) <= _SEGMENT:
            yield _Piece(first, offsets, 0, len(buf), lambda family, buf=buf: bytes_sequence(buf, family))
        else:
            for lo in range(0, len(buf), _SEGMENT):
                part = buf[lo : lo + _SEGMENT + 2 * unit.length]
                marks = np.array([0, len(part)])
                yield _Piece(first, marks, lo, _SEGMENT, lambda family, part=part: bytes_sequence(part, family))


def _units(u: int, n: int) -> pa.Array:
    return pa.array(np.full(n, u, np.int32))


def _runs(units: tuple[Unit, ...]):
    def run(batches):
        for batch in batches:
            for u, unit in enumerate(units):
                for piece in _pieces(batch.column("text"), unit):
                    if piece.size >= unit.length:
                        yield from of(batch, u, unit, piece)

    def of(batch, u, unit, piece):
        length, gram, offsets = unit.length, unit.gram, piece.offsets
        valid = np.zeros(piece.size - length + 1, bool)
        for start, n in zip(offsets[:-1].tolist(), (np.diff(offsets) - length + 1).tolist(), strict=True):
            if n > 0:
                valid[start : start + n] = True
        valid[piece.limit :] = False
        one = piece.sequence(0)
        grams = one.grams(gram)
        lo, hi, p = minimizer_runs(grams, length - gram + 1, valid)
        if not len(lo):
            return
        two = piece.sequence(1)
        shape = mix(((p - lo) * 1_000_003 + (hi - lo)).astype(U))
        row = np.searchsorted(offsets, lo, side="right") - 1
        take = pa.array(piece.first + row)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(take),
                batch.column("h").take(take),
                _units(u, len(lo)),
                signed(mix(grams[p] + U(u))),
                signed(one.hashes(lo, hi + length) ^ shape),
                signed(two.hashes(lo, hi + length)),
                pa.array((lo - offsets[row] + piece.shift).astype(np.int32)),
                pa.array((hi - lo + 1).astype(np.int32)),
                pa.array((p - lo).astype(np.int32)),
            ],
            names=["id", "h", "u", "a", "c1", "c2", "lo", "n", "g"],
        )

    return run


def _ranges_in_pieces(batch: pa.RecordBatch, units: tuple[Unit, ...], *fields: str):
    """``(u, piece, rows, values)``: where the texts of a piece have ranges of its unit, and their fields.

    ``rows`` has the row in the batch of every text of the piece. ``lo``, the first field, is counted from the start of
    the piece. A segment of a huge text gets all ranges of the text, also those that begin elsewhere.
    """
    column = batch.column("ranges")
    owner = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    flat = column.flatten()
    of = flat.field("u").to_numpy(zero_copy_only=False)
    values = [flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]
    for u, unit in enumerate(units):
        here = of == u
        rows, text = np.unique(owner[here], return_inverse=True)
        if not len(rows):
            continue
        lo, *more = [v[here] for v in values]
        for piece in _pieces(batch.column("text").take(pa.array(rows)), unit, _PART_BYTES):
            a, b = np.searchsorted(text, (piece.first, piece.first + len(piece.offsets) - 1))
            at = lo[a:b] - piece.shift + piece.offsets[text[a:b] - piece.first]
            yield u, piece, rows[piece.first :], [at, *[m[a:b] for m in more]]


def _parts(units: tuple[Unit, ...]):
    """Digits of the prefix and the whole of every part of the given runs; a run's gram is ``g`` after its first suffix."""

    def run(batches):
        for batch in batches:
            for u, piece, rows, (lo, n, g) in _ranges_in_pieces(batch, units, "lo", "n", "g"):
                length, radix = units[u].length, units[u].radix
                core = length - radix + 1  # what the suffixes of a part share, from the last one on
                cuts = [core * k // DIGITS for k in range(DIGITS + 1)]
                here = (lo >= 0) & (lo < piece.limit) & (lo + n + length - 1 <= piece.size)
                lo, n, g = lo[here], n[here], g[here]
                if not len(lo):
                    continue
                # distances d from a suffix to the gram: g - n + 1 .. g, cut at multiples of the radix
                low = (g - n + 1) // radix
                j, owner = spread_ranges(low, g // radix - low + 1)
                p = (lo + g)[owner]
                far = np.minimum(j * radix + radix - 1, g[owner])
                near = np.maximum(j * radix, (g - n + 1)[owner])
                first, last = p - far, p - near
                one, two = piece.sequence(0), piece.sequence(1)
                place = mix((j * 1_000_003 + far - near).astype(U))
                at = p - j * radix
                digits = [one.hashes(at + a, at + b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                digits[0] = mix((digits[0] ^ mix(j.astype(U))) + U(u))
                text = np.searchsorted(piece.offsets, first, side="right") - 1
                take = pa.array(rows[text])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        _units(u, len(first)),
                        *[signed(d) for d in digits],
                        signed(one.hashes(first, last + length) ^ place),
                        signed(two.hashes(first, last + length)),
                        pa.array((first - piece.offsets[text] + piece.shift).astype(np.int32)),
                        pa.array((far - near + 1).astype(np.int32)),
                    ],
                    names=["id", "h", "u", "d1", "d2", "d3", "w1", "w2", "lo", "n"],
                )

    return run


def _suffixes(units: tuple[Unit, ...]):
    """Hash through the full length of every suffix in the given ranges of a text."""

    def run(batches):
        for batch in batches:
            for u, piece, rows, (lo, n) in _ranges_in_pieces(batch, units, "lo", "n"):
                length = units[u].length
                at, _ = spread_ranges(lo, n)
                at = np.unique(at)
                at = at[(at >= 0) & (at < min(piece.limit, piece.size - length + 1))]
                if not len(at):
                    continue
                text = np.searchsorted(piece.offsets, at, side="right") - 1
                take = pa.array(rows[text])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(take),
                        batch.column("h").take(take),
                        _units(u, len(at)),
                        signed(piece.sequence(0).hashes(at, at + length)),
                        signed(piece.sequence(1).hashes(at, at + length)),
                        pa.array((at - piece.offsets[text] + piece.shift).astype(np.int32)),
                    ],
                    names=["id", "h", "u", "w1", "w2", "lo"],
                )

    return run


def _not_alone(stage: Stage, rows: DataFrame, digits: list[str], whole: list[str]) -> DataFrame:
    """A pass: rows whose prefix through the last of ``digits`` some other row shares.

    ``alike`` tells if all of them are equal in ``whole`` as well.
    """
    alike = [F.min(c) == F.max(c) for c in whole]
    shared = rows.groupBy(*digits).agg(F.count("*").alias("k"), (alike[0] & alike[1]).alias("alike")).where("k > 1")
    shared = stage.table(shared.select(*digits, "alike"), "shared")
    return stage.table(rows.drop("alike").join(shared, digits), "pass")


def _settled(
    stage: Stage, rows: DataFrame, prefix: list[str], whole: list[str], keep: list[str], keep_first: bool
) -> tuple[DataFrame, DataFrame]:
    """``(repeated, open)``: ranges that repeat as a whole, and representatives of those that may repeat in part.

    Ranges alike in ``prefix`` and ``whole`` are one class. Their suffixes repeat if they are several. Its first range
    stays open while another class has its prefix; unless it repeats anyhow, and so do all others.
    """
    key = [*prefix, *whole]
    place = F.struct("id", "h", "lo")
    judged = rows if keep_first else rows.where("NOT alike")
    classes = judged.groupBy(*key).agg(
        F.count("*").alias("k"), F.min(place).alias("first"), F.min_by(F.struct(*keep), place).alias("r")
    )
    classes = stage.table(classes, "classes")
    several = classes.groupBy(*prefix).agg(F.count("*").alias("all"), F.min("k").alias("least"))
    several = several.where("all > 1" if keep_first else "all > 1 AND least = 1").select(*prefix)
    several = stage.table(several, "several")
    open_ = stage.table(classes.join(several, prefix, "left_semi").select("r.*"), "open")
    copied = classes.where("k > 1").select(*key, "first")
    if keep_first:
        repeated = rows.join(copied, key).where(~place.eqNullSafe(F.col("first")))
    else:
        copied = judged.join(copied.select(*key), key, "left_semi")
        repeated = rows.where("alike").unionByName(copied)
    return repeated.select("id", "h", "u", "lo", "n"), open_


def repeated_ranges(
    stage: Stage, rows: DataFrame, units: tuple[Unit, ...] = (BYTES,), keep_first: bool = False
) -> DataFrame:
    """Ranges of elements (``id``, ``h``, ``u``, ``lo``, ``n``) covered by repeated windows; they may overlap.

    ``u`` is the number of the range's unit in ``units``.
    """
    kind = dict(rows.dtypes)["id"]
    narrow = rows.select("id", "h", "text")
    length = F.get(F.array(*[F.lit(unit.length) for unit in units]), F.col("u"))
    covered = (F.col("n") + length - 1).alias("n")

    runs = stage.table(narrow.mapInArrow(_runs(units), _RUN.format(kind)), "runs")
    met = _not_alone(stage, runs, ["a"], ["c1", "c2"])
    stage.drop(runs)
    whole_runs, open_runs = _settled(stage, met, ["a"], ["c1", "c2"], ["id", "h", "u", "lo", "n", "g"], keep_first)

    parts = with_ranges(narrow, open_runs, "inner").mapInArrow(_parts(units), _PART.format(kind))
    parts = stage.table(parts, "parts")
    digits = [f"d{k + 1}" for k in range(DIGITS)]
    for k in range(DIGITS):
        before, parts = parts, _not_alone(stage, parts, digits[: k + 1], ["w1", "w2"])
        stage.drop(before)
    whole_parts, open_parts = _settled(stage, parts, digits, ["w1", "w2"], ["id", "h", "u", "lo", "n"], keep_first)

    suffixes = with_ranges(narrow, open_parts, "inner").mapInArrow(_suffixes(units), _SUFFIX.format(kind))
    suffixes = stage.table(suffixes, "suffixes")
    key, place = ["u", "w1", "w2"], F.struct("id", "h", "lo")
    equal = suffixes.groupBy(*key).agg(F.count("*").alias("k"), F.min(place).alias("first"))
    equal = stage.table(equal.where("k > 1").select(*key, "first"), "equal")
    single = suffixes.join(equal, key)
    if keep_first:
        single = single.where(~place.eqNullSafe(F.col("first")))
    out = stage.table(
        whole_runs.select("id", "h", "u", "lo", covered)
        .unionByName(whole_parts.select("id", "h", "u", "lo", covered))
        .unionByName(single.select("id", "h", "u", "lo", length.alias("n"))),
        "ranges",
    )
    stage.drop(met, open_runs, parts, open_parts, suffixes, equal)
    return out


def _cut(batches):
    """Ranges are [lo, lo + n) in bytes, or in words where ``u`` is 1; those words are counted only."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        total, removed, spans, kept, said = [], [], [], [], []
        for text, (u, lo, n) in zip(
            batch.column("text"), range_arrays(batch.column("ranges"), "u", "lo", "n"), strict=True
        ):
            data = text.as_py().encode()
            start, end = merge_spans(lo[u == 1], (lo + n)[u == 1])
            said.append(int((end - start).sum()))
            start, end = merge_spans(lo[u == 0], (lo + n)[u == 0])
            spans.append([{"start": a, "end": b} for a, b in zip(start.tolist(), end.tolist())])
            total.append(len(data))
            removed.append(int((end - start).sum()))
            if len(start):
                edges = [0, *np.column_stack((start, end)).ravel().tolist(), len(data)]
                data = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            kept.append(data)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(total, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, kind),
                pa.array(kept, pa.binary()),
                pa.array(said, pa.int64()),
            ],
            names=["id", "n_bytes", "n_removed", "spans", "kept", "n_repeated_words"],
        )


def suffix_dedup(
    docs: DataFrame,
    unit: Unit = BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    passages: Unit | None = None,
) -> DataFrame:
    """Per row: ``id``, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs) and ``kept`` bytes.

    ``unit`` must be of bytes. With ``passages``, a unit of words, ``n_repeated_words`` counts the words inside windows
    of that unit that also start elsewhere; nothing is removed for them.
    """
    if unit.name != "bytes" or passages and passages.name != "words":
        raise ValueError("texts are cut by bytes, and passages are of words")
    stage = Stage(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    found = repeated_ranges(stage, rows, (unit, passages) if passages else (unit,))
    cut = with_ranges(rows, found, "left").mapInArrow(_cut, _RESULT.format(dict(rows.dtypes)["id"]))
    return cut if passages else cut.drop("n_repeated_words")


def _trimmed(text: pa.Array, ranges: pa.Array) -> pa.Array:
    """Texts without the words of the ranges; each takes the separators before it along."""
    kept = []
    for value, (lo, n) in zip(text, range_arrays(ranges), strict=True):
        data = value.as_py().encode()
        if not len(lo):
            kept.append(data.decode())
            continue
        buf = np.frombuffer(data, np.uint8)
        _, ends, _ = words(buf, np.array([0, len(buf)]))
        start, end = merge_spans(lo, lo + n)
        after = np.concatenate(([0], ends))  # where the separators before a word begin
        edges = [0, *np.column_stack((after[start], after[end])).ravel().tolist(), len(data)]
        kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])).decode())
    return pa.array(kept, pa.string())


def trim_repeats(
    docs: DataFrame, unit: Unit = WORDS, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars"
) -> DataFrame:
    """The rows with repeated passages cut out of their texts, but for a passage's first place; all columns stay.

    ``unit`` must be of words: every word goes that a window covers whose words also start in an earlier place, by
    id, then text hash, then position; null ids come first. ``count_col``, if there, is counted anew; a null text
    and a text without cuts stay as they are. Rows that repeat id and text are one document and trimmed alike.
    """
    if unit.name != "words":
        raise ValueError("texts are trimmed by words")
    stage = Stage(docs.sparkSession)
    rows = keyed(docs, id_col, text_col, keep_row=True)
    found = repeated_ranges(stage, rows.select("id", "h", "text"), (unit,), keep_first=True)
    listed = with_ranges(rows, found.drop("u"), "left")
    new = F.when(F.col("ranges").isNull(), F.col(f"row.`{text_col}`").cast("string")).otherwise(
        F.arrow_udf(_trimmed, "string")(F.col("text"), F.coalesce("ranges", F.array().cast("array<struct<lo:int,n:int>>")))
    )
    cut = listed.select("row", new.alias("new"))
    columns = []
    for name in docs.columns:
        value = F.col(f"row.`{name}`")
        if name == text_col:
            value = F.col("new")
        elif name == count_col:
            value = F.length("new").cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return cut.select(*columns)
