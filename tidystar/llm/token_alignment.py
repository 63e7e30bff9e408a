"""Alignment of two tokenizers' tokens over a corpus, each distinct text once.

Tokenizer A (byte-level BPE, ``tokenizers`` file) encodes a blank and the text, tokenizer
B (``sentencepiece`` model, which adds the blank itself) the text. Byte offsets where
tokens of both end cut them into groups; two tokens are linked if their byte ranges
overlap. A pair of ids counts as often as the corpus links it.

1. The documents are shuffled by their full text; each distinct text is kept once with
   its multiplicity.
2. One narrow pass tokenizes and aligns every distinct text and stores its measures and
   its distinct id pairs. Both tokenizers treat the stretches between single blanks
   independently (a blank only ever begins a token, and a token of both ends before it), so a
   task aligns each distinct stretch once while it remembers it. A stretch whose token
   bytes are not its own bytes sends its whole text through the libraries.
3. Pair counts: links of a text times its multiplicity, summed per task, then by Spark.
4. The counts return to the texts by blocks: texts lie in blocks of about ``BLOCK_BYTES``;
   each block asks once for its distinct pairs (a join on the pair, at most one row a block and
   pair) and gets its texts and its counts in one Arrow group of bounded size. The
   highest count of each B id has at most one row for each of B's pieces and is broadcast.
5. Measures meet the document ids by the SHA-256 of the text. Texts that make up more than
   1 in ``HOT`` of all rows (fewer than ``HOT`` rows, by this definition) are broadcast, so
   no key of the shuffled rest has more than that share.

Defined results: NULL or empty text, and text whose joined token bytes differ from blank +
text for A or B, has no tokens: all measures 0 and an empty group column. Rows are reported one by one,
whatever their ids; other columns are ignored; an empty table gives an empty result; a
very long text is aligned in parts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm.common import HOT, cut_lineage, join_hot, ragged, slices
from tidystar.llm.word_bpe import byte_letters

#: Text bytes of a block.
BLOCK_BYTES = 8 << 20
#: Characters aligned at a time.
PART_CHARS = 1 << 18
#: Stretches and their characters that a task remembers before it starts anew.
MEMO = 1 << 17
MEMO_CHARS = 1 << 23
#: New stretches given to the libraries as one text.
TOGETHER = 256

#: A single blank between characters that are not white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_B_BITS = 32


class TokenizerA:
    """Byte-level BPE file of the ``tokenizers`` library; special strings are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        self._library.encode_special_tokens = True
        split = self._library.pre_tokenizer
        split = json.loads(split.__getstate__()) if split is not None else {}
        #: Whether stretches that begin with a blank are encoded independently.
        self.by_stretch = self._library.normalizer is None and split.get("type") == "ByteLevel" \
            and split.get("use_regex") is True and split.get("add_prefix_space") is False
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        self.token_bytes = {i: bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
                            for token, i in self._library.get_vocab(with_added_tokens=False).items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch(texts, add_special_tokens=False)]


class TokenizerB:
    """A ``sentencepiece`` model that puts a blank before a text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._library = SentencePieceProcessor(model_file=path)
        pieces = [self._library.id_to_piece(i) for i in range(self._library.get_piece_size())]
        self.token_bytes = {i: bytes([int(p[3:5], 16)]) if self._library.is_byte(i) else p.replace("▁", " ").encode()
                            for i, p in enumerate(pieces)}
        #: No piece reaches over the beginning of a blank run.
        self.by_stretch = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._library.encode(texts, num_threads=1)


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked places (A, B) and the common ends of two tokenizations of the same bytes.

    Between two neighbouring ends of either lies exactly one overlap of one pair.
    """
    both = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
    twice = both[1:] == both[:-1]
    ends = both[np.concatenate([[True], ~twice])] if len(both) else both
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), both[1:][twice]


class Aligner:
    """Measures, groups and id pairs of whole texts.

    Remembers stretches: their groups as text (ended by ``;``), numbers of tokens, groups and links, and pair codes.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = TokenizerA(a_path), TokenizerB(b_path)
        self._by_stretch = self.a.by_stretch and self.b.by_stretch
        self._sizes = [np.zeros(max(t.token_bytes) + 1, np.int64) for t in (self.a, self.b)]
        for sizes, t in zip(self._sizes, (self.a, self.b)):
            sizes[list(t.token_bytes)] = [len(raw) for raw in t.token_bytes.values()]
        # every id in decimals before a comma, a bar and a semicolon
        self._ids = max(map(len, self._sizes))
        self._decimals = [f"{i}{mark}" for mark in ",|;" for i in range(self._ids)]
        self._decimal_sizes = np.array([len(d) for d in self._decimals])
        self._forget()

    def _forget(self) -> None:
        self._place: dict[str, int] = {}
        self._chars = 0
        self._groups: list[str] = []
        self._stats = np.zeros((0, 4), np.int64)
        self._pair_bounds = np.zeros(1, np.int64)
        self._pairs = np.zeros(0, np.int64)

    def _remember(self, stretches: list[str]) -> None:
        """Align new stretches; the place of one whose token bytes are not its own is -1."""
        new = [s for s in dict.fromkeys(stretches) if s not in self._place]
        # stretches are independent, so many go to the libraries as one text; those at the edge of a text may
        # have white space there and go alone
        edge = [s for s in new if not s or s[0].isspace() or s[-1].isspace()]
        if edge:
            alone = set(edge)
            inner = [s for s in new if s not in alone]
        else:
            inner = new
        units = [inner[i:i + TOGETHER] for i in range(0, len(inner), TOGETHER)] + [[s] for s in edge]
        while units:
            texts = [" ".join(unit) for unit in units]
            tokens = list(zip(units, texts, self.a.encode([" " + t for t in texts]), self.b.encode(texts)))
            good = [(unit, a, b) for unit, text, a, b in tokens if self._faithful(text, a, b)]
            bad = [unit for unit, text, a, b in tokens if not self._faithful(text, a, b)] if len(good) < len(units) else []
            if good:
                self._keep([s for unit, _, _ in good for s in unit], [g[1] for g in good], [g[2] for g in good])
            self._place.update((unit[0], -1) for unit in bad if len(unit) == 1)
            units = [[s] for unit in bad if len(unit) > 1 for s in unit]

    def _keep(self, stretches: list[str], a: list[list[int]], b: list[list[int]]) -> None:
        groups, stats, pairs = self._aligned(a, b, [len(s.encode("utf-8", "replace")) + 1 for s in stretches])
        self._place.update(zip(stretches, range(len(self._groups), len(self._groups) + len(stretches))))
        self._groups.extend(groups)
        self._stats = np.concatenate([self._stats, stats])
        self._pair_bounds = np.concatenate([self._pair_bounds, self._pair_bounds[-1] + np.cumsum(stats[:, 3])])
        self._pairs = np.concatenate([self._pairs, pairs])
        self._chars += sum(map(len, stretches))

    def _faithful(self, stretch: str, a: list[int], b: list[int]) -> bool:
        raw = b" " + stretch.encode("utf-8", "replace")
        return b"".join(map(self.a.token_bytes.__getitem__, a)) == raw \
            and b"".join(map(self.b.token_bytes.__getitem__, b)) == raw

    def _aligned(self, a_lists: list[list[int]], b_lists: list[list[int]], sizes: list[int]):
        """Groups as text, (n_a, n_b, n_groups, n_links) and pair codes of stretches of so many bytes."""
        a = np.fromiter(chain.from_iterable(a_lists), np.int64)
        b = np.fromiter(chain.from_iterable(b_lists), np.int64)
        a_ends, b_ends = np.cumsum(self._sizes[0][a]), np.cumsum(self._sizes[1][b])
        i, j, common = overlaps(a_ends, b_ends)
        last = np.cumsum(sizes)
        stats = np.diff(np.stack([np.searchsorted(ends, last, "right") for ends in (
            a_ends, b_ends, common, np.minimum(a_ends[i], b_ends[j]))], axis=1), axis=0, prepend=0)
        # A's tokens of a group, then B's; the last of each is marked
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_mark, b_mark = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_mark[np.searchsorted(a_ends, common)] = 1
        b_mark[np.searchsorted(b_ends, common)] = 2
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        listed = np.concatenate([a_mark * self._ids + a, b_mark * self._ids + b])[order]
        text = "".join(map(self._decimals.__getitem__, listed.tolist()))
        at = np.concatenate([[0], np.cumsum(self._decimal_sizes[listed])])[np.cumsum(stats[:, 0] + stats[:, 1])].tolist()
        groups = [text[x:y] for x, y in zip([0, *at], at)]
        return groups, stats, (a[i] << _B_BITS) | b[j]

    @staticmethod
    def _parts(text: str):
        """The stretches of a text, some ``PART_CHARS`` characters at a time."""
        at = 0
        while len(text) - at > PART_CHARS and (cut := _CUT.search(text, at + PART_CHARS)):
            yield _CUT.split(text[at:cut.start()])
            at = cut.end()
        yield _CUT.split(text[at:] if at else text)

    def measure(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, SHA-256 of the groups, pair codes, their links."""
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        if not self._by_stretch:
            return [text and self._whole(text) or nothing for text in texts]
        short = [_CUT.split(text) if text and len(text) <= PART_CHARS else None for text in texts]
        self._make_room()
        self._remember([s for parts in short if parts for s in parts])
        found = [parts and self._sum([parts], text) or nothing for parts, text in zip(short, texts)]
        for i, text in enumerate(texts):  # long ones may make the others forgotten
            if text and len(text) > PART_CHARS:
                found[i] = self._sum(None, text) or nothing
        return found

    def _make_room(self) -> None:
        if len(self._groups) > MEMO or self._chars > MEMO_CHARS:
            self._forget()

    def _sum(self, known: list | None, text: str):
        """The measures of a text from its remembered stretches; a long one is remembered part by part."""
        total, digest, codes, links, held = np.zeros(4, np.int64), hashlib.sha256(), [], [], ""
        for parts in known or self._parts(text):
            if known is None:
                self._make_room()
                self._remember(parts)
            at = np.fromiter(map(self._place.__getitem__, parts), np.int64, len(parts))
            if at.min() < 0:
                return self._whole(text)
            one, many = np.unique(at, return_counts=True)
            total += many @ self._stats[one]
            digest.update(held.encode())
            held = "".join(map(self._groups.__getitem__, at.tolist()))
            n = self._pair_bounds[one + 1] - self._pair_bounds[one]
            codes.append(self._pairs[ragged(self._pair_bounds[one], n)])
            links.append(np.repeat(many, n))
            if len(codes) > 16:
                codes, links = ([x] for x in _summed(np.concatenate(codes), np.concatenate(links)))
        digest.update(held[:-1].encode())
        return (*total.tolist(), digest.hexdigest(), *_summed(np.concatenate(codes), np.concatenate(links)))

    def _whole(self, text: str):
        """The same by the libraries on the whole text; None if token bytes differ."""
        a, b = self.a.encode([" " + text])[0], self.b.encode([text])[0]
        if not self._faithful(text, a, b):
            return None
        groups, stats, pairs = self._aligned([a], [b], [len(text.encode("utf-8", "replace")) + 1])
        return (*stats[0].tolist(), hashlib.sha256(groups[0][:-1].encode()).hexdigest(),
                *_summed(pairs, np.ones(len(pairs), np.int64)))


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    """One for all tasks of a worker process."""
    return Aligner(a_path, b_path)


def _summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their counts."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(counts, first)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)))


def aligned_texts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Blocks of aligned texts: block, key, copies, measures and id pairs of every row of ``texts`` (text, copies)."""
    names = ["block", "key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "links"]

    def run(batches):
        aligner, block, held = _aligner(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, "text"):
            texts, blocks = batch.column("text").to_pylist(), []
            found = aligner.measure(texts)
            for text in texts:
                blocks.append(block)
                held += len(text)
                if held >= BLOCK_BYTES:
                    block, held = block + 1, 0
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), batch.column("key"), batch.column("copies"),
                 *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4]),
                 _lists(list(columns[5])), _lists(list(columns[6]))], names=names)

    return texts.select("text", F.unhex(F.sha2("text", 256)).alias("key"), "copies").mapInArrow(
        run, "block bigint, key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "groups_sha256 string, codes array<bigint>, links array<bigint>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of a list column without NULLs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, count): links of each id pair over the corpus; the code holds A's id above 32 bits of B's."""
    def run(batches):
        for batch in batches:
            codes, sizes = _flat(batch.column("codes"))
            links, _ = _flat(batch.column("links"))
            codes, counts = _summed(codes, links * np.repeat(np.asarray(batch.column("copies")), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "count"])

    return aligned.select("copies", "codes", "links").mapInArrow(run, "code bigint, count bigint") \
        .groupBy("code").agg(F.sum("count").alias("count"))


def _asked(aligned: DataFrame) -> DataFrame:
    """(block, code): the distinct pairs of each Arrow batch's part of a block."""
    def run(batches):
        for batch in batches:
            blocks = np.asarray(batch.column("block"))
            codes, sizes = _flat(batch.column("codes"))
            of = np.repeat(blocks, sizes)
            for block in np.unique(blocks):
                found = np.unique(codes[of == block])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), pa.array(found)],
                                                 names=["block", "code"])

    return aligned.select("block", "codes").mapInArrow(run, "block bigint, code bigint")


def _measured(texts: pa.Table, counts: pa.Table) -> pa.Table:
    """Best links and count sums of the texts of one block."""
    known, first = np.unique(counts.column("code").to_numpy(), return_index=True)
    count, best = counts.column("count").to_numpy()[first], np.asarray(counts.column("best"))[first]
    codes, sizes = _flat(texts.column("codes"))
    links, _ = _flat(texts.column("links"))
    at = np.searchsorted(known, codes)
    row = np.repeat(np.arange(texts.num_rows), sizes)
    n_best, count_sum = np.zeros(texts.num_rows, np.int64), np.zeros(texts.num_rows, np.int64)
    if len(codes):
        np.add.at(n_best, row, links * best[at])
        np.add.at(count_sum, row, links * count[at])
    return pa.table([*(texts.column(c) for c in _MEASURES), pa.array(n_best), pa.array(count_sum)],
                    names=[*_MEASURES, "n_best", "count_sum"])


_MEASURES = ["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def align_tokenizers(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair count is the highest of their B id.
    """
    docs = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = docs.where("text != ''").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = cut_lineage(spark, aligned_texts(texts, a_path, b_path), "aligned")
    counts = cut_lineage(spark, pair_counts(aligned), "pair-counts")
    b_id = F.col("code").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("highest"))  # one row a piece of B
    ranked = counts.join(F.broadcast(highest), b_id == F.col("b")) \
        .select("code", "count", (F.col("count") == F.col("highest")).cast("bigint").alias("best"))
    told = _asked(aligned).join(ranked, "code").select("block", "code", "count", "best")
    measured = cut_lineage(spark, aligned.select("block", *_MEASURES, "codes", "links").groupBy("block").cogroup(
        told.groupBy("block")).applyInArrow(
            lambda left, right: _measured(left, right),
            "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "n_best bigint, count_sum bigint"), "measured")

    keyed = docs.where("text != ''").select("id", F.unhex(F.sha2("text", 256)).alias("key"))
    out = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    told = join_hot(keyed, measured, "key", "copies", HOT)
    blank = docs.where("text IS NULL OR text = ''").select(
        "id", *(F.lit(0).cast("bigint").alias(c) for c in out[1:-1]), F.lit("").alias("groups_sha256"))
    return told.select(out).union(blank).withColumnRenamed("id", id_col)
