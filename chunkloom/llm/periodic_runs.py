"""Periodic runs of words: Lyndon roots extended both ways by suffix-tree queries.

A run is a stretch of consecutive words of one document with smallest period q and length of at least ``least`` and
``exponent * q`` that no neighbouring word extends keeping the period.

* Stretches. Inside a run every ``GRAM`` words occur again at most q further or nearer, so at most a quarter of the
  stretch's length away (the exponent's share). Positions that fail this break the document into shorter stretches,
  which are judged again. A run never crosses such a break and no word beyond one extends it, so nothing is
  lost; ordinary text has hardly any stretch left.
* Trees. For the words of a stretch, compared as bytes, Ukkonen's suffix trees of the stretch and of its reversal are
  built. An Euler tour, kept as the depths of the nodes where it turns between neighbouring leaves, answers the depth of
  a lowest common ancestor, the longest common extension, in constant time from a table of minima.
* Roots. The longest Lyndon word at a position ends at the next smaller suffix. Every run holds such a word as a
  root, for the order of words or for its reverse, so two candidates a position, extended to the left and to the
  right, give all runs.

One document is one task's work; texts are not shuffled, and memory grows with the longest text only. Null, empty and
short texts have no runs. Repeated rows and null ids give a row each. Other columns are ignored, whatever their names.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.numeric import U, Sequence, mix, text_blocks, word_hashes, words

EXPONENT = 4
LEAST = 6
GRAM = 4
_ROUNDS = 12
_RUN = [("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]
_RESULT = "id {}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def stretches(grams: np.ndarray, text: np.ndarray, exponent: int, least: int) -> list[tuple[int, int]]:
    """Ranges of words, each in one text, that hold all runs. ``grams`` are those of ``GRAM`` words, ``text`` their text.

    Needs ``exponent`` >= 3 and ``least`` >= ``GRAM`` + 2: then any gram of a run has its like in the run.
    """
    at = np.flatnonzero(text >= 0)
    owner = text[at]
    for _ in range(_ROUNDS):  # stopping early leaves longer stretches, not fewer runs
        if not len(at):
            break
        first = np.concatenate(([True], (np.diff(at) != 1) | (owner[1:] != owner[:-1])))
        part = np.cumsum(first) - 1
        size = np.bincount(part)[part] + GRAM - 1
        key = grams[at] ^ mix(part.astype(U))
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        gap = np.where(same, at[order[1:]] - at[order[:-1]], np.iinfo(np.int64).max >> 8)
        near = np.full(len(at), np.iinfo(np.int64).max >> 8)
        near[order[:-1]] = gap
        near[order[1:]] = np.minimum(near[order[1:]], gap)
        stay = (near * exponent <= size) & (size >= least)
        if stay.all():
            break
        at, owner = at[stay], owner[stay]
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (owner[1:] != owner[:-1]))))
    last = np.concatenate((first[1:], [len(at)])) - 1
    begin, end = at[first], at[last] + GRAM
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist(), strict=True))


def suffix_tree(s: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's tree of a sequence whose last symbol is 0 and occurs once: parent, first symbol and depth of each node."""
    n, width = len(s), max(s) + 1
    start, end, link, up, go = [0], [0], [0], [0], {}
    node = edge = length = rest = 0
    for i, c in enumerate(s):
        rest += 1
        waiting = 0
        while rest:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = go.get(key)
            if child is None:
                go[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                up.append(node)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                begin = start[child]
                span = min(end[child], i + 1) - begin
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                if s[begin + length] == c:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                middle = len(start)
                start += (begin, i)
                end += (begin + length, n)
                link += (0, 0)
                up += (node, middle)
                go[key] = middle
                go[middle * width + c] = middle + 1
                start[child] = begin + length
                up[child] = middle
                go[middle * width + s[begin + length]] = child
                if waiting:
                    link[waiting] = middle
                waiting = middle
            rest -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - rest + 1
    first = np.array(s)[start]
    own = (np.array(end) - np.array(start)).tolist()
    depth = [0] * len(up)
    order, children = [0], _children(np.array(up), first)
    for v in order:  # parents before children
        for child in children(v):
            depth[child] = depth[v] + own[child]
            order.append(child)
    return np.array(up), first, np.array(depth)


def _children(up: np.ndarray, symbol: np.ndarray):
    """The children of a node by ascending symbol."""
    order = np.lexsort((symbol[1:], up[1:])) + 1
    bound = np.searchsorted(up[order], np.arange(len(up) + 1)).tolist()
    order = order.tolist()
    return lambda v: order[bound[v] : bound[v + 1]]


def tour(tree, n: int, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of an Euler tour as starts of suffixes, and the depth where the tour turned before each of them.

    ``reverse`` takes greater symbols first, but the end symbol 0 before all.
    """
    up, symbol, depth = tree
    if reverse:
        symbol = np.where(symbol == 0, 0, symbol.max() + 1 - symbol)
    children = _children(up, symbol)
    depths, parent = depth.tolist(), up.tolist()
    leaves, turns, turned, stack = [], [], 0, [0]
    from_left = [True] * len(depths)
    while stack:
        v = stack.pop()
        if not from_left[v]:
            turned = depths[parent[v]]
        below = children(v)
        if below:
            for child in below[1:]:
                from_left[child] = False
            stack += below[::-1]
        else:
            leaves.append(n - depths[v])
            turns.append(turned)
    return np.array(leaves), np.array(turns, np.int32)


class Extensions:
    """Longest common extensions of pairs of suffixes in constant time each."""

    def __init__(self, leaves: np.ndarray, turns: np.ndarray):
        n = len(leaves)
        self.rank = np.empty(n, np.int64)
        self.rank[leaves] = np.arange(n)
        rows = [turns]
        while 2 << (len(rows) - 1) <= n:
            half = 1 << (len(rows) - 1)
            row = rows[-1].copy()
            row[:-half] = np.minimum(rows[-1][:-half], rows[-1][half:])
            rows.append(row)
        self.minima = np.stack(rows)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common length of the suffixes at ``i`` and ``j``, which differ."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        k = np.frexp((high - low + 1).astype(float))[1] - 1
        return np.minimum(self.minima[k, low], self.minima[k, high - (1 << k) + 1])


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix the start of the next smaller one; the last suffix, the end symbol, is the smallest."""
    rank = rank.tolist()
    out, open_ = [0] * len(rank), []
    for j, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = j
        open_.append(j)
    return np.array(out)


def runs_of(symbols: list[int], exponent: int = EXPONENT, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in a sequence of symbols from 1, by start and period."""
    n = len(symbols)
    if n < least:
        return []
    tree = suffix_tree(symbols + [0])
    forward = Extensions(*tour(tree, n + 1))
    leaves, _ = tour(tree, n + 1, reverse=True)
    other = np.empty(n + 1, np.int64)
    other[leaves] = np.arange(n + 1)
    backward = Extensions(*tour(suffix_tree(symbols[::-1] + [0]), n + 1))
    found = set()
    i = np.arange(n)
    for rank in (forward.rank, other):
        j = _next_smaller(rank)[:n]
        right = np.where(j < n, forward.of(i, j), 0)
        left = np.where(i > 0, backward.of(n - i, n - j), 0)
        period = j - i
        length = left + period + right
        whole = np.flatnonzero(length >= np.maximum(least, exponent * period))
        found.update(zip((i - left)[whole].tolist(), length[whole].tolist(), period[whole].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _found(exponent: int, least: int):
    def run(batches):
        for batch in batches:
            counts, runs, kept = [], [], []
            for _, _, buf, offsets in text_blocks(batch.column("text")):
                for n, found, text in _in_block(buf, offsets, exponent, least):
                    counts.append(n)
                    runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                    kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(runs, pa.list_(pa.struct(_RUN))),
                    pa.array(kept, pa.string()),
                ],
                names=["id", "n_words", "runs", "collapsed"],
            )

    return run


def _in_block(buf: np.ndarray, offsets: np.ndarray, exponent: int, least: int):
    """(number of words, runs, text without repetitions) of every text of a block."""
    starts, ends, text = words(buf, offsets)
    found: dict[int, list] = {}
    if len(starts) >= least:
        grams = Sequence(word_hashes(buf, starts, ends, 0), 0).grams(GRAM)
        inside = np.where(text[: len(grams)] == text[GRAM - 1 :], text[: len(grams)], -1)
        for a, b in stretches(grams, inside, exponent, least):
            ids: dict[bytes, int] = {}
            symbols = [
                ids.setdefault(buf[x:y].tobytes(), len(ids) + 1)
                for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)
            ]
            runs = runs_of(symbols, exponent, least)
            if runs:
                row = int(text[a])
                shift = a - int(np.searchsorted(text, row))
                found.setdefault(row, []).extend((s + shift, n, q) for s, n, q in runs)
    data = buf.tobytes()
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        said = data[a:b].split()
        n, runs = len(said), sorted(found.get(row, ()), key=lambda r: (r[0], r[2]))
        if runs:
            change = np.zeros(n + 1, np.int64)
            for s, length, q in runs:
                change[s + q] += 1
                change[s + length] -= 1
            said = [w for w, gone in zip(said, np.cumsum(change).tolist()) if not gone]
        yield n, runs, b" ".join(said).decode()


def periodic_runs(
    docs: DataFrame,
    exponent: int = EXPONENT,
    least: int = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``runs`` (by start and period) and ``collapsed``.

    ``collapsed`` has the words, joined by one space, that no run contains after its first period.
    """
    if exponent < 3 or least < GRAM + 2:
        raise ValueError(f"exponent must be at least 3 and least at least {GRAM + 2}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text)
    return rows.mapInArrow(_found(exponent, least), _RESULT.format(dict(rows.dtypes)["id"]))
