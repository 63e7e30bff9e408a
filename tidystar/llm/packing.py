"""Hierarchical multi-length packing of whole documents into token windows.

Context-size tiers are powers of two up to the window length. Per partition, in
one narrow pass:

* a document is tokenized whole and ends with ``eos_id``; full long windows are
  cut from its front, the rest goes to the smallest tier that holds it;
* a long window opens with a piece of the top tier and its gap is filled from
  the pools of shorter tiers, longest first; the last filler is cut to fit and
  its rest returns to its tier;
* a shorter tier that holds more than it needs as filler is packed into windows
  of its own size, again cut to fit;
* what is left at the end of a partition fills long windows, and the last rest
  is cut into powers of two, so no window carries padding;
* windows are dealt to step groups of equal token totals (the last groups of a
  partition may be short).

Pools hold at most ``HOLD`` windows per tier, whatever the partition's size. A
retried task sees the same rows in the same order and gives the same windows;
``sequence_id`` carries the partition number in its high bits.

Defined results: NULL or empty text is a document of the one token ``eos_id``;
NULL and repeated ids are packed row by row; other columns are ignored; an
empty table gives no pieces.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidystar.llm.common import SLICE_BYTES, slices, text_buffers
from tidystar.llm.word_bpe import BatchEncoder

TIERS = (256, 512, 1024, 2048)
#: Windows' worth of tokens that a tier keeps back as filler for longer ones.
HOLD = 16
#: Text bytes encoded at a time; the arrays of the splitting take many times as many.
ENCODED_BYTES = SLICE_BYTES // 4
#: Tokens of a step group.
STEP_TOKENS = 64 * 2048

_FIELDS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
           "sequence_tokens", "step_group")


class Packer:
    """Packs the documents of one partition; ``emit`` receives finished windows' pieces."""

    def __init__(self, partition: int, tiers=TIERS, hold: int = HOLD, step_tokens: int = STEP_TOKENS):
        self.tiers, self.window, self.hold = tuple(tiers), tiers[-1], hold
        self.pools = {t: deque() for t in tiers}
        self.held = dict.fromkeys(tiers, 0)
        self.base = partition << 40
        self.windows = 0
        self.step_tokens, self.groups, self.last_group = step_tokens, {}, -1
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self._emit([(doc_id, at, ids[at:at + self.window], total)])
            at += self.window
        if at < total:
            self._route((doc_id, at, ids[at:], total))
            self._drain()

    def finish(self) -> None:
        left = deque(p for t in reversed(self.tiers) for p in self.pools[t])
        total = sum(len(p[2]) for p in left)
        for t in self.tiers:
            self.pools[t].clear()
            self.held[t] = 0
        while total:
            size = self.window if total >= self.window else 1 << (total.bit_length() - 1)
            self._emit(self._take(left, size))
            total -= size

    def _route(self, piece) -> None:
        tier = next(t for t in self.tiers if len(piece[2]) <= t)
        self.pools[tier].append(piece)
        self.held[tier] += len(piece[2])

    @staticmethod
    def _cut(piece, n: int):
        doc_id, at, ids, total = piece
        return (doc_id, at, ids[:n], total), (doc_id, at + n, ids[n:], total)

    def _take(self, pool: deque, size: int) -> list:
        """Exactly ``size`` tokens from the front of ``pool``."""
        taken = []
        while size:
            piece = pool.popleft()
            if len(piece[2]) > size:
                piece, rest = self._cut(piece, size)
                pool.appendleft(rest)
            taken.append(piece)
            size -= len(piece[2])
        return taken

    def _fill(self, pieces: list, gap: int, tiers) -> int:
        """Fill ``gap`` from the pools of ``tiers``; returns what stays open."""
        for t in tiers:
            while gap and self.pools[t]:
                piece = self.pools[t].popleft()
                self.held[t] -= len(piece[2])
                if len(piece[2]) > gap:
                    piece, rest = self._cut(piece, gap)
                    self._route(rest)
                pieces.append(piece)
                gap -= len(piece[2])
        return gap

    def _drain(self) -> None:
        top, shorter = self.tiers[-1], self.tiers[-2::-1]
        while self.pools[top]:
            gap = top - len(self.pools[top][0][2])
            if sum(self.held[t] for t in shorter) < gap and self.held[top] <= self.hold * top:
                break  # wait for fillers
            pieces = [self.pools[top].popleft()]
            self.held[top] -= len(pieces[0][2])
            self._emit(pieces) if not self._fill(pieces, gap, (*shorter, top)) else self._return(pieces)
            if not self.pools[top]:
                break
        for t in shorter:
            while self.held[t] > self.hold * t:
                pieces = self._take(self.pools[t], t)
                self.held[t] -= t
                if self.pools[t]:  # a cut rest may belong to a shorter tier
                    rest = self.pools[t].popleft()
                    self.held[t] -= len(rest[2])
                    self._route(rest)
                self._emit(pieces)

    def _return(self, pieces: list) -> None:
        for piece in pieces:
            self._route(piece)

    def _emit(self, pieces: list) -> None:
        size, offset = sum(len(p[2]) for p in pieces), 0
        group = next((g for g, room in self.groups.items() if room >= size), None)
        if group is None:
            self.last_group += 1
            group = self.last_group
            self.groups[group] = max(self.step_tokens, size)
        self.groups[group] -= size
        if not self.groups[group]:
            del self.groups[group]
        for doc_id, at, ids, total in pieces:
            self.rows.append((doc_id, at, len(ids), ids.astype("<u4").tobytes(), total,
                              self.base + self.windows, offset, size, self.base + group))
            offset += len(ids)
        self.windows += 1


def pack_documents(docs: DataFrame, tokenizer_path: str, eos_id: int = 1, tiers=TIERS,
                   step_tokens: int = STEP_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; ``ids`` holds its token ids as little-endian unsigned 32-bit."""
    id_type = docs.schema[id_col].dataType
    schema = (f"doc_id {id_type.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, "
              "sequence_id bigint, offset bigint, sequence_tokens bigint, step_group bigint")

    def run(batches):
        encoder = BatchEncoder(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId(), tiers, step_tokens=step_tokens)
        arrow_id = None

        def out():
            columns = list(zip(*packer.rows))
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], arrow_id)]
                + [pa.array(c, pa.binary() if name == "ids" else pa.int64())
                   for name, c in zip(_FIELDS[1:], columns[1:])], names=list(_FIELDS))

        for batch in slices(batches, "text", ENCODED_BYTES):
            arrow_id = batch.schema.field("doc_id").type
            ids, bounds = encoder.encode(*text_buffers(batch.column("text")))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                packer.add(doc_id, np.append(ids[a:b], np.uint32(eos_id)))
            if packer.rows:
                yield out()
        packer.finish()
        if packer.rows:
            yield out()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_tokens", "step_group")
