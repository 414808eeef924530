"""Token counts of whole texts, as the tokenizer's library gives them.

A huge text is encoded in overlapping chunks with offsets, so that neither memory nor one library call
grows with it. Two neighbouring chunks are spliced at a stable common boundary in their overlap: a place
after white space where both start a token and both ended the token before. The tokenizers accepted here
split at white space, drop it, and look at nothing across it (this is read from the tokenizer's file when it is
loaded), so what follows such a place does not depend on what precedes it. If an overlap holds no such place, it
is doubled until it does or until the text ends.

The same boundaries allow the words of ordinary texts to be counted one by one. Counts of words are
remembered by each worker, up to ``MEMO`` words, which is where most of the time is saved.

Null counts as the empty text: no bytes, no tokens. Rows are independent; repeated rows give repeated results.
Special strings inside texts are handled as the library does by default; none are added.
"""

import functools
import json
import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
OVERLAP = 1 << 9
MEMO = 400_000
_SPACE = " \t\n\v\f\r"


def _splits_at_space(path: str) -> bool:
    """Whether the file's tokenizer drops white space and never lets a token or rule reach across it."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)

    def flat(x, many):
        return [] if x is None else [z for y in x[many] for z in flat(y, many)] if many in x else [x]

    before, cut = flat(told["normalizer"], "normalizers"), flat(told["pre_tokenizer"], "pretokenizers")
    plain = all(
        x["type"] in ("NFC", "Lowercase")
        or (x["type"] == "Replace" and x["pattern"] == {"Regex": "\\s+"} and x["content"] == " ")
        for x in before
    )
    split = any(
        x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]
        and not any(s in x["pattern"].get("Regex", " ") for s in _SPACE)
        and "^\\s" in x["pattern"]["Regex"] and "?" not in x["pattern"]["Regex"]
        for x in cut
    )
    special = [x for x in told["added_tokens"] if set(x["content"]) & set(_SPACE) or x["lstrip"] or x["rstrip"]]
    return plain and split and not special and told["post_processor"] is None


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not _splits_at_space(path):
        raise ValueError(f"{path}: no boundary is known to be stable for this tokenizer")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _common_boundary(text: str, low: int, left: list, right: list) -> int | None:
    """Last place >= low after white space where both encodings start a token, or None.

    ``left`` and ``right`` hold (start, end) of tokens in the whole text's positions.
    """
    ends = {start: (left[i - 1][1] if i else None) for i, (start, _) in enumerate(left)}
    for i in range(len(right) - 1, 0, -1):
        start = right[i][0]
        if start < low:
            return None
        if start in ends and text[start - 1] in _SPACE and ends[start] == right[i - 1][1] < start:
            return start
    return None


def count_huge(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text from overlapping chunks."""

    def encoded(lo, hi):
        found = tokenizer.encode(text[lo:hi], add_special_tokens=False).offsets
        return [(a + lo, b + lo) for a, b in found]

    total, begin, lo = 0, 0, 0
    hi = min(len(text), chunk)
    current = encoded(lo, hi)
    while hi < len(text):
        width = overlap
        while True:
            next_lo = max(hi - width, begin)
            next_hi = min(len(text), next_lo + chunk + width)
            following = encoded(next_lo, next_hi)
            inside = [t for t in following if t[1] < hi]
            at = _common_boundary(text, next_lo + 1, current, inside)
            if at is not None and at > begin:
                break
            if next_lo == begin:
                # nothing in common: the chunk itself has to grow
                hi = min(len(text), hi + max(chunk, hi - lo))
                current = encoded(lo, hi)
                if hi == len(text):
                    return total + sum(a >= begin for a, _ in current)
                width = overlap
                continue
            width *= 2
        total += sum(begin <= a < at for a, _ in current)
        begin, lo, hi, current = at, next_lo, next_hi, following
    return total + sum(a >= begin for a, _ in current)


def _counts(path: str, chunk: int, overlap: int):
    memo: dict[bytes, int] = {}

    def small(texts: list[str], tokenizer) -> list[int]:
        pieces = [text.encode().split() for text in texts]
        new = list(set().union(*pieces).difference(memo))
        if len(memo) + len(new) > MEMO:
            memo.clear()
            new = list(set().union(*pieces))
        for lo in range(0, len(new), 4096):
            part = new[lo : lo + 4096]
            made = tokenizer.encode_batch_fast([x.decode() for x in part], add_special_tokens=False)
            memo.update(zip(part, map(len, made)))
        return [sum(map(memo.__getitem__, found)) for found in pieces]

    def run(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            column = pc.fill_null(batch.column("text"), "")
            counts = [0] * len(column)
            waiting, size = [], 0
            for i, text in enumerate(column):
                text = text.as_py()
                if len(text) > chunk:
                    counts[i] = count_huge(text, tokenizer, chunk, overlap)
                    continue
                waiting.append((i, text))
                size += len(text)
                if size > 1 << 20 or len(waiting) == 512:
                    for (j, _), n in zip(waiting, small([t for _, t in waiting], tokenizer)):
                        counts[j] = n
                    waiting, size = [], 0
            for (j, _), n in zip(waiting, small([t for _, t in waiting], tokenizer)):
                counts[j] = n
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``n_bytes`` (UTF-8) and ``n_tokens``. ``tokenizer_path`` is read on the executors."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(
        _counts(tokenizer_path, chunk, overlap), f"id {kind}, n_bytes long, n_tokens long"
    )
