"""Word BPE through a minimal acyclic transducer of frequent words.

1. One pass counts the words of all texts (summed per task, then by Spark). The
   words counted often enough are the lexicon: the lowest count is chosen so
   that at most ``LEXICON`` words pass it. The lexicon only decides which words
   are looked up instead of merged, never an id.
2. The words in byte order, with their ids, are compiled into the minimal
   subsequential transducer: states that accept the same suffixes with the same
   remaining ids are one state, and each arc gives the ids that all words
   beyond it share and no earlier arc gave.
3. The transducer is one flat file of 32-bit integers, arcs in the order of
   (state, byte), that every task maps into memory, so the tasks of a machine
   share its pages.
4. Texts are cut into words with numpy; the distinct words of a slice walk the
   transducer in step, one byte at a time, and collect the ids of their arcs.
   Words that it does not accept are merged by the file's ranked pairs, lowest
   rank first and leftmost among equals, as the library merges.

Only ``LEXICON`` words reach the driver; they are compiled there. Words longer
than ``LONGEST`` bytes are always merged.

Defined results: NULL or empty text has no ids and decodes to the empty string.
Special tokens inside a text are their own ids, as in the library. Repeated rows
are each encoded; an empty table gives an empty result (and an empty lexicon);
very long texts are cut at blanks, where words end anyway. A file whose
normalizer or splitter is not the one repeated here is an error.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterable
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidystar.llm.common import (SLICE_BYTES, annotate, blank_cuts, cut_lineage, mix64, ragged,
                                 seeded_words, slices, text_buffers)
from tidystar.llm.word_bpe import byte_letters, has_plain_rules, split_pieces
from tidystar.session import scratch_path

#: Most words of a lexicon.
LEXICON = 1 << 17
#: Longest word of a lexicon, in bytes (three 64-bit words).
LONGEST = 24
#: Words whose count or merged ids a task keeps before it starts anew.
MEMO = 1 << 17
_NO_PAIR = (1 << 62, -1)
_MIX = seeded_words(31, 3, odd=True)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


# --- the tokenizer file ----------------------------------------------------------
class WordRules:
    """Splitting, ranked pairs and token strings of a word BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if not has_plain_rules(spec):
            raise ValueError(f"{path}: another normalizer or splitter than the one repeated here")
        spec["truncation"] = spec["padding"] = None
        library = Tokenizer.from_str(json.dumps(spec))
        self._normalize, self._pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        letters = byte_letters()
        self._bytes = {ord(letter): byte for byte, letter in letters.items()}
        self._special = sorted(((t["content"], t["id"]) for t in spec["added_tokens"]), key=lambda t: -len(t[0]))
        ids = spec["model"]["vocab"]
        self._inside = [ids.get(letters[b]) for b in range(256)]
        self._last = [ids.get(letters[b] + "</w>") for b in range(256)]
        if None in self._inside or None in self._last:
            raise ValueError(f"{path}: a byte has no token")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self._pairs = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.tokens = {i: t.encode() for t, i in [*ids.items(), *self._special]}

    def words(self, chunk: str) -> list:
        """The words (bytes) and special ids (int) of a chunk without blanks."""
        out: list = []
        while chunk:
            found = [(at, -len(text), text, i) for text, i in self._special if (at := chunk.find(text)) >= 0]
            at, _, text, special = min(found) if found else (len(chunk), 0, "", None)
            for piece, _ in self._pieces(self._normalize(chunk[:at])):
                out.append(bytes(self._bytes[ord(c)] for c in piece))
            if special is not None:
                out.append(special)
            chunk = chunk[at + len(text):]
        return out

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word: the pair of lowest rank first, leftmost among equals."""
        ids: list = [self._inside[b] for b in word]
        ids[-1] = self._last[word[-1]]
        n = len(ids)
        pairs = self._pairs
        if n <= LONGEST:
            ranked = [pairs.get(pair, _NO_PAIR) for pair in zip(ids, ids[1:])]
            while ranked and (best := min(ranked)) is not _NO_PAIR:
                i = ranked.index(best)
                ids[i:i + 2] = best[1:]
                del ranked[i]
                if i:
                    ranked[i - 1] = pairs.get((ids[i - 1], ids[i]), _NO_PAIR)
                if i < len(ranked):
                    ranked[i] = pairs.get((ids[i], ids[i + 1]), _NO_PAIR)
            return tuple(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(p[0], i, p[1], ids[i], ids[i + 1]) for i in range(n - 1) if (p := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, joined, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = joined, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if p := pairs.get((joined, ids[k])):
                    heapq.heappush(queue, (p[0], i, p[1], joined, ids[k]))
            if (h := before[i]) >= 0 and (p := pairs.get((ids[h], joined))):
                heapq.heappush(queue, (p[0], h, p[1], ids[h], joined))
        return tuple(i for i in ids if i is not None)


# --- the transducer ----------------------------------------------------------------
def minimal_transducer(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> list[tuple]:
    """States of the minimal subsequential transducer; the last one is the start.

    ``entries`` are distinct non-empty words in byte order with their ids. A state is
    (final ids or None, ((byte, target state, arc ids), ...)).
    """
    states: list[tuple] = []
    known: dict[tuple, int] = {}

    def settle(final, arcs: dict) -> int:
        state = (final, tuple((b, t, o) for b, (t, o) in arcs.items()))
        if state not in known:
            known[state] = len(states)
            states.append(state)
        return known[state]

    # the states along the last word: final ids and arcs (byte -> [target, ids])
    finals: list = [None]
    arcs: list[dict] = [{}]
    last = b""
    for word, ids in entries:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for i in range(len(last), same, -1):
            arcs[i - 1][last[i - 1]][0] = settle(finals.pop(), arcs.pop())
        for i in range(same, len(word)):
            arcs[i][word[i]] = [None, ()]
            finals.append(None)
            arcs.append({})
        finals[-1] = ()
        left = ids
        for i in range(same):
            arc = arcs[i][word[i]]
            if arc[1]:
                n = 0
                while n < len(left) and n < len(arc[1]) and left[n] == arc[1][n]:
                    n += 1
                if n < len(arc[1]):  # what the words do not share moves one state on
                    moved, arc[1] = arc[1][n:], arc[1][:n]
                    for other in arcs[i + 1].values():
                        other[1] = moved + other[1]
                    if finals[i + 1] is not None:
                        finals[i + 1] = moved + finals[i + 1]
                left = left[n:]
        arcs[same][word[same]][1] = left
        last = word
    for i in range(len(last), 0, -1):
        arcs[i - 1][last[i - 1]][0] = settle(finals.pop(), arcs.pop())
    states.append((finals[0], tuple((b, t, o) for b, (t, o) in arcs[0].items())))
    return states


_PARTS = ("key", "target", "out_at", "out_n", "final_at", "final_n", "pool")


def flatten(states: list[tuple]) -> bytes:
    """The transducer as one block of 32-bit integers: start state, lengths of the parts, parts.

    Arcs lie in the order of their keys (256 * state + byte).
    """
    parts: dict[str, list[int]] = {name: [] for name in _PARTS}
    places: dict[tuple, int] = {}

    def put(ids: tuple, at: str, n: str) -> None:
        if ids not in places:
            places[ids] = len(parts["pool"])
            parts["pool"].extend(ids)
        parts[at].append(places[ids])
        parts[n].append(len(ids))

    for s, (final, arcs) in enumerate(states):
        if final is None:
            parts["final_at"].append(-1)
            parts["final_n"].append(-1)
        else:
            put(final, "final_at", "final_n")
        for label, to, ids in arcs:
            parts["key"].append(256 * s + label)
            parts["target"].append(to)
            put(ids, "out_at", "out_n")
    head = [len(states) - 1, *(len(parts[p]) for p in _PARTS)]
    return b"".join(np.array(x, np.int32).tobytes() for x in (head, *(parts[p] for p in _PARTS)))


class Transducer:
    """Looks words up in a flat transducer (bytes, or a file that is mapped into memory)."""

    def __init__(self, source: bytes | str):
        flat = np.frombuffer(source, np.int32) if isinstance(source, bytes) else np.memmap(source, np.int32, "r")
        self._start, sizes = int(flat[0]), flat[1:1 + len(_PARTS)].tolist()
        at = 1 + len(_PARTS)
        for name, size in zip(_PARTS, sizes):
            setattr(self, f"_{name}", flat[at:at + size])
            at += size

    def ids(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """(accepted, counts, ids): the ids of the accepted words, concatenated; others count 0."""
        n = len(starts)
        state = np.full(n, self._start, np.int32)
        counts = np.zeros(n, np.int64)
        accepted = np.zeros(n, bool)
        emitted: list[tuple] = []  # words, places within their ids, where in the pool, how many

        def emit(words, at, many):
            some = many > 0
            words, at, many = words[some], at[some], many[some].astype(np.int64)
            emitted.append((words, counts[words], at, many))
            counts[words] += many

        alive = np.flatnonzero((sizes > 0) & (sizes <= LONGEST))
        for step in range(LONGEST + 1):
            ends = sizes[alive] == step
            if ends.any():
                done = alive[ends]
                many = self._final_n[state[done]]
                done, many = done[many >= 0], many[many >= 0]
                accepted[done] = True
                emit(done, self._final_at[state[done]], many)
                alive = alive[~ends]
            if not len(alive):
                break
            key = state[alive] * np.int32(256) + data[starts[alive] + step]
            slot = np.searchsorted(self._key, key)
            found = self._key[np.minimum(slot, len(self._key) - 1)] == key if len(self._key) else np.zeros(len(key), bool)
            alive, slot = alive[found], slot[found]
            state[alive] = self._target[slot]
            emit(alive, self._out_at[slot], self._out_n[slot])
        counts[~accepted] = 0
        begins = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.uint32)
        for words, place, at, many in emitted:
            keep = accepted[words]
            words, place, at, many = words[keep], place[keep], at[keep], many[keep]
            ids[ragged(begins[words] + place, many)] = self._pool[ragged(at.astype(np.int64), many)]
        return accepted, counts, ids


# --- words of a batch ----------------------------------------------------------------
def _distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct word of at most ``LONGEST`` bytes, and the place of each word in that list.

    Equal codes of different words (never seen) leave every word by itself.
    """
    padded = np.concatenate([data, np.zeros(LONGEST, np.uint8)])
    longs = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    keys = [longs[starts + 8 * i] & _MASK[np.clip(sizes - 8 * i, 0, 8)] for i in range(3)]
    code = mix64(keys[0] * _MIX[0] + mix64(keys[1] * _MIX[1] + mix64(keys[2] * _MIX[2] + sizes.astype(np.uint64))))
    _, one, which = np.unique(code, return_index=True, return_inverse=True)
    if any((k != k[one][which]).any() for k in keys) or (sizes != sizes[one][which]).any():
        return np.arange(len(starts)), np.arange(len(starts))
    return one, which


class WordCutter:
    """Cuts texts into words: bytes, bounds and special ids (-1 for a word)."""

    def __init__(self, rules: WordRules):
        self._rules = rules

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(bytes, starts, sizes, special ids, where each text's words begin)."""
        none = np.zeros(0, np.int64)
        if not len(data):
            return data, none, none, none, np.zeros(len(offsets), np.int64)
        lower, starts, ends, odd = split_pieces(data, offsets)
        bounds = np.searchsorted(starts, offsets)
        if not odd.any():
            return lower, starts, ends - starts, np.full(len(starts), -1), bounds
        chunks = [self._rules.words(data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace"))
                  for i in np.flatnonzero(odd).tolist()]
        flat = [w for words in chunks for w in words]
        lengths = np.array([0 if isinstance(w, int) else len(w) for w in flat], np.int64)
        many = np.ones(len(starts), np.int64)
        many[odd] = [len(words) for words in chunks]
        place = np.concatenate([[0], np.cumsum(many)])
        new_start, new_size = np.empty(place[-1], np.int64), np.empty(place[-1], np.int64)
        special = np.full(place[-1], -1, np.int64)
        plain = place[:-1][~odd]
        new_start[plain], new_size[plain] = starts[~odd], (ends - starts)[~odd]
        at = ragged(place[:-1][odd], many[odd])
        new_start[at] = len(lower) + np.cumsum(lengths) - lengths
        new_size[at] = lengths
        special[at] = [w if isinstance(w, int) else -1 for w in flat]
        extra = np.frombuffer(b"".join(w for w in flat if not isinstance(w, int)), np.uint8)
        return np.concatenate([lower, extra]), new_start, new_size, special, place[bounds]


class Encoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, lexicon: bytes | str):
        self.rules = WordRules(path)
        self._cut = WordCutter(self.rules)
        self._lexicon = Transducer(lexicon)
        self._merged: dict[bytes, tuple[int, ...]] = {}

    def _merge(self, word: bytes) -> tuple[int, ...]:
        found = self._merged.get(word)
        if found is None:
            found = self.rules.merge(word)
            if len(word) <= LONGEST:
                if len(self._merged) >= MEMO:
                    self._merged.clear()
                self._merged[word] = found
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and their bounds."""
        if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:  # one very long text: piece by piece
            parts = [self._encode(data[a:b], np.array([0, b - a]))[0] for a, b in blank_cuts(data)]
            ids = np.concatenate(parts)
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, starts, sizes, special, bounds = self._cut(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        short = np.flatnonzero((special < 0) & (sizes <= LONGEST))
        one, which = _distinct(data, starts[short], sizes[short])
        first = short[one]
        accepted, known_n, known = self._lexicon.ids(data, starts[first], sizes[first])
        # every distinct word's ids: accepted ones, then merged ones, then single special and long words
        unseen = first[~accepted]
        alone = np.flatnonzero((special >= 0) | (sizes > LONGEST))
        text = data.tobytes() if len(unseen) + len(alone) else b""

        def merged(i):
            return (int(special[i]),) if special[i] >= 0 else self._merge(text[starts[i]:starts[i] + sizes[i]])

        found = [merged(i) for i in np.concatenate([unseen, alone]).tolist()]
        found_n = np.fromiter(map(len, found), np.int64, len(found))
        found_ids = np.fromiter((i for f in found for i in f), np.uint32, int(found_n.sum()))
        found_at = len(known) + np.cumsum(found_n) - found_n
        pool = np.concatenate([known, found_ids])
        at, n = np.cumsum(known_n) - known_n, known_n.copy()
        at[~accepted], n[~accepted] = found_at[:len(unseen)], found_n[:len(unseen)]
        word_at, word_n = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        word_at[short], word_n[short] = at[which], n[which]
        word_at[alone], word_n[alone] = found_at[len(unseen):], found_n[len(unseen):]
        ends = np.concatenate([[0], np.cumsum(word_n)])
        return pool[ragged(word_at, word_n)], ends[bounds]


# --- on Spark ----------------------------------------------------------------
def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(word binary, n): how often each word of at most ``LONGEST`` bytes occurs in all texts."""
    def run(batches):
        cut = WordCutter(WordRules(path))
        total: dict[bytes, int] = {}

        def flush():
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(total.values(), pa.int64())],
                                             names=["word", "n"])
            total.clear()

        for batch in slices(batches, text_col):
            data, offsets = text_buffers(batch.column(text_col))
            pieces = blank_cuts(data) if len(offsets) == 2 else [(0, len(data))]
            for a, b in pieces:
                bounds = np.array([0, b - a]) if len(offsets) == 2 else offsets
                words, starts, sizes, special, _ = cut(data[a:b], bounds)
                short = np.flatnonzero((special < 0) & (sizes > 0) & (sizes <= LONGEST))
                if not len(short):
                    continue
                one, which = _distinct(words, starts[short], sizes[short])
                text, n = words.tobytes(), np.bincount(which)
                for s, size, many in zip(starts[short[one]].tolist(), sizes[short[one]].tolist(), n.tolist()):
                    word = text[s:s + size]
                    total[word] = total.get(word, 0) + many
                if len(total) >= MEMO:
                    yield from flush()
        if total:
            yield from flush()

    return docs.select(text_col).mapInArrow(run, "word binary, n bigint") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int = LEXICON) -> list[bytes]:
    """The words with a count that at most ``most`` words reach, in byte order.

    The lowest count comes from a histogram of counts to three binary digits (some 200 rows).
    """
    step = F.expr("shiftleft(1L, greatest(length(bin(n)) - 3, 0))")
    bins = counts.groupBy((F.col("n") - F.col("n") % step).alias("least")).count().orderBy(F.desc("least")).collect()
    least, held = None, 0
    for row in bins:
        held += row["count"]
        if held > most:
            break
        least = row["least"]
    if least is None:
        return []
    return sorted(bytes(row["word"]) for row in counts.where(F.col("n") >= least).select("word").toLocalIterator())


def compile_lexicon(words: Iterable[bytes], path: str) -> bytes:
    """The flat transducer of distinct words in byte order, with the ids of the tokenizer file."""
    rules = WordRules(path)
    return flatten(minimal_transducer((w, rules.merge(w)) for w in words))


def publish_lexicon(spark: SparkSession, flat: bytes) -> str:
    """Store a flat transducer in the shared folder; the name by which tasks find it.

    A folder that machines mount is mapped where it is; from any other store Spark
    copies the file to its executors.
    """
    uri = scratch_path(spark, "lexicon")
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(uri)
    out = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(file)
    out.write(flat)
    out.close()
    if urlparse(uri).scheme not in ("", "file"):
        spark.sparkContext.addFile(uri)
    return uri


def _local_file(uri: str) -> str:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else SparkFiles.get(os.path.basename(parts.path))


def encode(spark: SparkSession, docs: DataFrame, path: str, keep: list[str], text_col: str = "text",
           out: str = "ids", lexicon_words: int = LEXICON) -> DataFrame:
    """The ``keep`` columns and each whole text's ids (binary, little-endian unsigned 32-bit)."""
    words = frequent_words(cut_lineage(spark, word_counts(docs, path, text_col), "word-counts"), lexicon_words)
    lexicon = publish_lexicon(spark, compile_lexicon(words, path))

    def make():
        encoder = Encoder(path, _local_file(lexicon))

        def run(column):
            ids, bounds = encoder.encode(*text_buffers(column))
            raw = ids.astype("<u4").tobytes()
            return [pa.array([raw[4 * a:4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())]

        return run

    return annotate(docs, text_col, keep, f"{out} binary", make)


def decode(rows: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` and the text of each row's ids: the token strings, special ones too, joined by blanks.

    The file names no decoder, so this is what the library's ``decode`` gives; unknown ids give nothing.
    """
    def run(batches):
        tokens = WordRules(path).tokens
        for batch in slices(batches, ids_col):
            found = [b" ".join([tokens[i] for i in np.frombuffer(raw, "<u4").tolist() if i in tokens]) if raw else b""
                     for raw in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary()).cast(pa.string())],
                                             names=[*batch.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField(out, T.StringType())]))
