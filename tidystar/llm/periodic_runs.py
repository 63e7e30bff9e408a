"""Periodic runs of words by branching tandem repeats in an enhanced suffix array.

A run is a stretch of words with smallest period ``q`` that no neighbouring word
extends. All documents of a slice are worked on together, in numpy:

1. Words become numbers (equal words, equal numbers). The suffix array of every
   document follows by prefix doubling; only suffixes that still tie are sorted again.
2. LCP values are compared directly where the preceding words differ
   (irreducible ones) and follow by subtraction elsewhere.
3. Every LCP interval of depth ``d`` is found from the nearest smaller values on
   both sides; no tree is built. For the suffixes ``i`` of all its children but
   the largest, ``ISA[i + d]`` and ``ISA[i - d]`` are looked up: if that suffix
   lies in the interval but in another child, the two make a branching tandem
   repeat, a square of root length ``d`` that cannot be moved to the right.
4. A square is rotated to the left as long as it stays a square; its first
   place and its end bound a run. Squares of the same stretch are merged; the
   smallest root goes first and is the period, so squares of repeated roots leave no
   run and are not rotated.

Steps 2 to 4 take O(n log n) word comparisons for n words, whatever repeats. A
document is worked on by one task (its words are numbers of four bytes; a few
arrays of that length are held), so memory follows the longest document.

Defined results: NULL, empty or blank text has no words and no runs. Rows are
handled one by one, whatever their ids; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidystar.llm.common import SLICE_BYTES, blank_cuts, ragged, slices, text_buffers

#: Words compared at a time, over all comparisons that go on.
_BLOCK = 1 << 16


def suffix_ranks(words: np.ndarray, document: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse over all documents; a document's suffixes lie together.

    ``ends`` is the end of each word's document; a suffix ends there and sorts before longer ones.
    """
    n = len(words)
    # the start value of a rank is the place of its first suffix, so ranks only grow finer
    order = np.lexsort((words, document))
    first = np.ones(n, bool)
    first[1:] = (words[order[1:]] != words[order[:-1]]) | (document[order[1:]] != document[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    depth = 1
    while True:
        alone = first.copy()
        alone[:-1] &= first[1:]
        open_at = np.flatnonzero(~alone)  # places whose suffix ties with another
        if not len(open_at):
            return order, rank
        suffix = order[open_at]
        beyond = suffix + depth
        follow = np.where(beyond < ends[suffix], rank[np.minimum(beyond, n - 1)] + 1, 0)
        own = rank[suffix]
        again = np.lexsort((follow, own))
        suffix, own, follow = suffix[again], own[again], follow[again]
        order[open_at] = suffix
        fresh = np.ones(len(suffix), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])
        first[open_at] = fresh
        rank[suffix] = open_at[np.maximum.accumulate(np.where(fresh, np.arange(len(suffix)), 0))]
        depth *= 2


def extensions(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on, in direction ``step`` (1 or -1), are equal, up to ``room``."""
    length = np.zeros(len(a), np.int64)
    alive, width = np.flatnonzero(room > 0), 1
    while len(alive):
        width = min(2 * width, max(1, _BLOCK // len(alive)))
        offset = np.arange(width)
        left = (room - length)[alive]
        inside = offset < left[:, None]
        at = np.where(inside, (length[alive][:, None] + offset) * step, 0)
        same = inside & (words[a[alive][:, None] + at] == words[b[alive][:, None] + at])
        run = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
        length[alive] += run
        alive = alive[(run == width) & (left > width)]
    return length


def neighbour_lcp(words: np.ndarray, order: np.ndarray, rank: np.ndarray, begins: np.ndarray,
                  ends: np.ndarray) -> np.ndarray:
    """LCP of each suffix with the one before it in the array; 0 between documents."""
    n = len(words)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    before[before >= 0] = np.where(begins[before[before >= 0]] == begins[np.flatnonzero(before >= 0)],
                                   before[before >= 0], -1)
    at = np.arange(n)
    reducible = (before >= 0) & (at > begins) & (before > begins)
    i = np.flatnonzero(reducible)
    reducible[i] = (words[i - 1] == words[before[i] - 1]) & (before[i - 1] == before[i] - 1)
    by_text = np.zeros(n, np.int64)
    i = np.flatnonzero(~reducible & (before >= 0))
    by_text[i] = extensions(words, i, before[i], np.minimum(ends[i] - i, ends[i] - before[i]), 1)
    source = np.maximum.accumulate(np.where(reducible, 0, at))
    by_text = by_text[source] - (at - source)
    return by_text[order]


def nearest_smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at`` (``lcp`` > 0): the last place before and the first after with a smaller value.

    Blocks of doubling length are skipped as long as their minimum is not smaller.
    """
    n = len(lcp)
    value = lcp[at]
    minima = [lcp]
    while (1 << len(minima)) <= n and (minima[-1] > 0).any():
        half, last = 1 << (len(minima) - 1), minima[-1]
        minima.append(np.minimum(last[:-half], last[half:]))
    left, right = at - 1, at + 1  # all between them and ``at`` is at least ``value``
    for level in range(len(minima) - 1, -1, -1):
        span, low = 1 << level, minima[level]
        for _ in range(2 if level == len(minima) - 1 else 1):
            start = left - span + 1
            skip = (start >= 0) & (low[np.maximum(start, 0)] >= value)
            left = np.where(skip, left - span, left)
            skip = (right + span <= n) & (low[np.minimum(right, len(low) - 1)] >= value)
            right = np.where(skip, right + span, right)
    return left, right


def branching_squares(order: np.ndarray, rank: np.ndarray, lcp: np.ndarray, begins: np.ndarray, ends: np.ndarray,
                      least: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(start, root length) of the branching tandem repeats whose document holds ``least`` roots."""
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(lcp > 0)
    at = at[least * lcp[at] <= (ends - begins)[order[at]]]
    if not len(at):
        return none, none
    # an interval [low, high) of depth d: its places with LCP d part it into children
    low, high = nearest_smaller(lcp, at)
    low = np.maximum(low, 0)
    sort = np.lexsort((at, low, lcp[at]))
    at, low, high = at[sort], low[sort], high[sort]
    depth = lcp[at]
    head = np.ones(len(at), bool)
    head[1:] = (depth[1:] != depth[:-1]) | (low[1:] != low[:-1])
    group = np.cumsum(head) - 1
    heads = np.flatnonzero(head)
    # children: [low, first place), [place, next place) ..., [last place, high)
    parts = np.diff(np.append(heads, len(at))) + 1
    first_child = np.cumsum(parts) - parts
    child_low = np.empty(int(parts.sum()), np.int64)
    child_low[first_child] = low[heads]
    child_low[np.arange(len(at)) + group + 1] = at
    child_high = np.empty_like(child_low)
    child_high[:-1] = child_low[1:]
    child_high[first_child + parts - 1] = high[heads]
    owner = np.repeat(np.arange(len(heads)), parts)
    size = child_high - child_low
    biggest = np.maximum.reduceat(size, first_child)[owner]
    seen = np.cumsum(size == biggest)
    large = (size == biggest) & (seen - (seen - (size == biggest))[first_child][owner] == 1)  # one per interval
    small = np.flatnonzero(~large)
    leaf_child = np.repeat(small, size[small])
    suffix = order[ragged(child_low[small], size[small])]
    of = owner[leaf_child]
    d = depth[heads][of]
    found = []
    for shift in (1, -1):
        other = suffix + shift * d
        ok = np.flatnonzero((other < ends[suffix]) & (other >= begins[suffix]))
        place = rank[other[ok]]
        inside = (place >= low[heads][of[ok]]) & (place < high[heads][of[ok]])
        inside &= (place < child_low[leaf_child[ok]]) | (place >= child_high[leaf_child[ok]])
        ok = ok[inside]
        found.append((np.minimum(suffix[ok], other[ok]), d[ok]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _maximal(words: np.ndarray, begins: np.ndarray, start: np.ndarray, root: np.ndarray):
    """(start, length, period) of the stretches that hold the branching squares.

    Of the squares with one end, the smallest root is rotated to the left first. Squares
    that lie in the stretch it gives repeat that root, and are merged with it unrotated; any
    other begins a longer stretch of its own. One round for each such nesting.
    """
    end = start + 2 * root
    sort = np.lexsort((root, end))
    start, end, root = start[sort], end[sort], root[sort]
    found = []
    while len(start):
        head = np.ones(len(end), bool)
        head[1:] = end[1:] != end[:-1]
        at = np.flatnonzero(head)
        s, d = start[at], root[at]
        s = s - extensions(words, s - 1, s + d - 1, s - begins[s], -1)
        found.append((s, end[at] - s, d))
        left = start < s[np.cumsum(head) - 1]
        start, end, root = start[left], end[left], root[left]
    return tuple(np.concatenate(x) for x in zip(*found))


def runs(words: np.ndarray, bounds: np.ndarray, least_length: int = 6, least_exponent: int = 4):
    """(document, start, length, period) of all runs of the documents, by document, start and period.

    ``words`` are numbers; ``bounds`` says where each document begins and ends.
    """
    none = np.zeros(0, np.int64)
    n = len(words)
    if not n:
        return none, none, none, none
    sizes = np.diff(bounds)
    document = np.repeat(np.arange(len(sizes)), sizes)
    begins, ends = bounds[:-1][document], bounds[1:][document]
    order, rank = suffix_ranks(words, document, ends)
    lcp = neighbour_lcp(words, order, rank, begins, ends)
    start, root = branching_squares(order, rank, lcp, begins, ends, max(least_exponent, 2))
    if not len(start):
        return none, none, none, none
    start, length, root = _maximal(words, begins, start, root)
    keep = (length >= least_length) & (length >= least_exponent * root)
    start, length, root = start[keep], length[keep], root[keep]
    sort = np.lexsort((root, start))
    start, length, root = start[sort], length[sort], root[sort]
    return document[start], start - begins[start], length, root


class _Numbers:
    """Numbers of words; equal words, equal numbers."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def of(self, data: np.ndarray) -> np.ndarray:
        known = self._known
        parts = [(0, len(data))] if len(data) <= 2 * SLICE_BYTES else blank_cuts(data)
        found = []
        for a, b in parts:
            # splits at space and TAB..CR, the blanks of ASCII
            words = data[a:b].tobytes().split()
            found.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
        return np.concatenate(found) if len(found) != 1 else found[0]

    def words(self) -> list[bytes]:
        return list(self._known)


def planted(n: int, doc_id) -> np.ndarray | None:
    """Which original word stands at each place after the fixed rule of the query ``op13``; None: unchanged.

    Of documents whose crc32 of the id is a multiple of 10, words from some place on are made periodic.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at >= a, a + (at - a) % p, at)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
              least_exponent: int = 4, arrange=None) -> DataFrame:
    """Per row: id, n_words, its runs (array of start, length, period) and the text without repetitions.

    ``collapsed`` holds the words that no run covers after that run's first period,
    joined by blanks. ``arrange(n, id)`` may give the order in which a document's
    words are taken (an index array or None). One narrow pass.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in slices(batches, "text"):
            data, offsets = text_buffers(batch.column("text"))
            numbers = _Numbers()
            texts = []
            for (a, b), doc_id in zip(zip(offsets[:-1].tolist(), offsets[1:].tolist()),
                                      batch.column("id").to_pylist() if arrange else [None] * batch.num_rows):
                words = numbers.of(data[a:b])
                index = arrange(len(words), doc_id) if arrange else None
                texts.append(words if index is None else words[index])
            vocabulary = numbers.words()
            sizes = np.array([len(t) for t in texts], np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            words = np.concatenate(texts) if texts else np.zeros(0, np.int32)
            document, start, length, period = runs(words, bounds, least_length, least_exponent)
            # a word goes if some run covers it after its first period
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, bounds[document] + start + period, 1)
            np.add.at(change, bounds[document] + start + length, -1)
            stays = np.cumsum(change[:-1]) == 0
            collapsed = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                kept = words[a:b][stays[a:b]].tolist()
                collapsed.append(b" ".join([vocabulary[w] for w in kept]))
            per_doc = np.concatenate([[0], np.cumsum(np.bincount(document, minlength=len(sizes)))])
            found = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                               fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), found),
                 pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n_words bigint, "
                                "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string") \
        .withColumnRenamed("id", id_col)


def runs_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``find_runs``: number of runs, the strongest run, SHA-256 of runs and collapsed text.

    The strongest run has the greatest exact length / period, then the smallest start, then period.
    Two exponents are compared by their cross products.
    """
    stronger = F.reduce(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") == 0, F.lit("")).otherwise(F.concat(F.array_join(line, "\n"), F.lit("\n")))
    top = F.col("top_run")
    return found.select(id_col, "runs", "collapsed", stronger.alias("top_run")).select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), top["start"].alias("start"),
        top["length"].alias("length"), top["period"].alias("period"),
        F.expr("1000 * top_run.length div top_run.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
