"""Byte-level BPE encoding and decoding with the ``tiktoken`` library and a local rank file.

Texts are encoded as the library's ``encode_ordinary`` would: every match of the
split pattern separately, no special tokens. A long text is first cut at
positions where the pattern always ends a match, so the pieces' ids are the
text's ids:

* before a blank that follows a non-blank (no match runs over a blank inside);
* between a letter and a digit, and between a letter or digit and a following
  character of another kind.

A long run of white space is one match except for its last character; it is
given to the library as a match of its own, because the pattern's look-ahead
would otherwise backtrack over the whole run. Decoding joins the raw bytes of
the ids.

Defined results: NULL counts as the empty text, which has no ids and decodes to
no bytes. Repeated rows are each encoded; an empty table gives an empty result;
a text that is not valid UTF-8 is read with replacement characters.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidystar.llm.common import annotate

#: Characters given to the library at a time.
PIECE_CHARS = 1 << 16
#: White space runs from this length on are cut out.
LONG_RUN = 1 << 12

_CUT = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})|(?<=[\p{L}\p{N}])(?=[^\s\p{L}\p{N}])")
_RUN = regex.compile(r"\s{%d,}" % LONG_RUN)


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a ``.tiktoken`` file (base64 token, blank, rank)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """An encoder and decoder for one rank file and split pattern."""

    def __init__(self, rank_path: str, pattern: str):
        import tiktoken

        ranks = read_ranks(rank_path)
        self._split = tiktoken.Encoding("split", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def pieces(self, text: str):
        """(piece, whole): pieces whose ids concatenate to the text's; ``whole`` marks a single match."""
        at = 0
        for run in _RUN.finditer(text):
            yield from self._cut(text, at, run.start())
            # the run's last character goes with what follows it
            at = run.end() if run.end() == len(text) else run.end() - 1
            yield text[run.start():at], True
        yield from self._cut(text, at, len(text))

    @staticmethod
    def _cut(text: str, at: int, end: int):
        while end - at > PIECE_CHARS:
            cut = _CUT.search(text, at + PIECE_CHARS, end)
            if cut is None or cut.start() >= end:
                break
            yield text[at:cut.start()], False
            at = cut.start()
        if at < end:
            yield text[at:end], False

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_RUN:
            return self._split.encode_ordinary(text)
        return list(chain.from_iterable(
            (self._whole if whole else self._split).encode_ordinary(piece) for piece, whole in self.pieces(text)))

    def decode(self, ids) -> bytes:
        return self._split.decode_bytes(ids)


def encode(docs: DataFrame, rank_path: str, pattern: str, keep: list[str], text_col: str = "text",
           out: str = "ids") -> DataFrame:
    """The ``keep`` columns and the ids of each whole text (array of int)."""
    def make():
        bpe = ByteBpe(rank_path, pattern)

        def run(column):
            found = [bpe.encode(t) if t else [] for t in column.to_pylist()]
            sizes = np.fromiter(map(len, found), np.int32, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))]

        return run

    return annotate(docs, text_col, keep, f"{out} array<int>", make)


def decode(rows: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` and the raw bytes of each row's ids (NULL ids: no bytes)."""
    def run(batches):
        bpe = ByteBpe(rank_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [bpe.decode(ids) if ids else b"" for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())],
                                                 names=[*part.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(out, T.BinaryType())]))


def ids_digest(ids_col: str = "ids"):
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids_col).cast("array<string>"), ","), 256)
