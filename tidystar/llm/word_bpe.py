"""Batch encoding with a ``tokenizers`` word BPE file.

Most pieces of a text recur, so a batch is cut into pieces with numpy, pieces
are looked up in a fixed-size table, and only new ones go through the
library's BPE model. The cutting repeats the file's normalizer and splitter
for blank-separated chunks of ASCII and the Latin letters U+00C0..U+00FF; any
other chunk (and one with an apostrophe or ``<``, where contractions or special
tokens may lie) is given to the library whole. Chunks are independent in this
kind of tokenizer because white space is dropped. A file with another normalizer
or splitter is detected when it is loaded; its texts go through the library whole.
"""

from __future__ import annotations

import json

import numpy as np

from tidystar.llm.common import SLICE_BYTES, blank_cuts, is_blank, mix64, ragged, seeded_words

_BLANK, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
#: Longest piece kept in the table, in bytes (three 64-bit words).
_PIECE = 24
#: Most ids of a piece kept in the table; the few pieces with more are encoded anew.
_KEPT = 8
#: Every worker holds a table of its own, and rare words fill it whatever its size: 57 bytes a slot.
_SLOT_BITS = 18
_MIX = seeded_words(21, 3, odd=True)
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def _classes() -> np.ndarray:
    out = np.full(256, _ODD, np.uint8)
    out[0x21:0x7F] = _OTHER
    out[ord("0"):ord("9") + 1] = _DIGIT
    out[ord("A"):ord("Z") + 1] = _LETTER
    out[ord("a"):ord("z") + 1] = _LETTER
    out[[ord("'"), ord("<")]] = _ODD
    out[[0x20, *range(9, 14)]] = _BLANK
    return out


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, others from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_CLASS = _classes()

#: The normalizer, splitter and word end that ``split_pieces`` repeats (fixed values of the file format).
_PLAIN_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}
_PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
                "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


def has_plain_rules(spec: dict) -> bool:
    """Whether a tokenizer file (its JSON) normalizes and splits as ``split_pieces`` does.

    Added tokens must be found in raw text only, hold ``<`` and no blank, so that they lie in odd chunks.
    """
    added = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])
                and "<" in t["content"] and not any(c.isspace() for c in t["content"])
                for t in spec.get("added_tokens") or [])
    model = spec["model"]
    return added and all(spec.get(k) == v for k, v in _PLAIN_RULES.items()) \
        and all(model.get(k) == v for k, v in _PLAIN_MODEL.items())


def split_pieces(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, piece starts and ends, and which pieces are odd chunks.

    Holds for files that ``has_plain_rules`` accepts.
    """
    n = len(data)
    kind = _CLASS[data]
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    if len(lead):
        tail = data[lead + 1]
        letter = (tail != 0x97) & (tail != 0xB7)
        lead, tail = lead[letter], tail[letter]
        kind[lead] = kind[lead + 1] = _LETTER
        lower[lead + 1] += (tail < 0x9F).astype(np.uint8) * np.uint8(32)
    begins = np.zeros(n, bool)
    begins[offsets[:-1][offsets[:-1] < n]] = True
    blank = is_blank(data)
    odd = np.flatnonzero(kind == _ODD)
    if len(odd):
        chunk = begins.copy()
        chunk[1:] |= blank[:-1]
        at = np.flatnonzero(chunk & ~blank)
        stop = np.append(np.flatnonzero(blank | begins), n)
        hit = np.unique(np.searchsorted(at, odd, "right") - 1)
        ends = stop[np.searchsorted(stop, at[hit], "right")]
        kind[ragged(at[hit], ends - at[hit])] = _ODD
    first = begins | (kind == _DIGIT)
    first[1:] |= kind[1:] != kind[:-1]
    first[0] = True
    edges = np.flatnonzero(first)
    ends = np.append(edges[1:], n)
    real = kind[edges] != _BLANK
    starts, ends = edges[real], ends[real]
    return lower, starts, ends, kind[starts] == _ODD


class BatchEncoder:
    """Ids of whole texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # no texts are cut or padded here, whatever the file says
        spec["truncation"] = spec["padding"] = None
        self._plain = has_plain_rules(spec)
        self._tokenizer = Tokenizer.from_str(json.dumps(spec))
        self._model = self._tokenizer.model
        self._letters = byte_letters()
        slots = 1 << _SLOT_BITS
        self._keys = np.zeros((3, slots), np.uint64)
        self._len = np.zeros(slots, np.uint8)
        self._ids = np.zeros((slots, _KEPT), np.uint32)

    def _piece(self, raw: bytes) -> list[int]:
        return [t.id for t in self._model.tokenize(raw.decode("latin-1").translate(self._letters))]

    def _chunk(self, raw: bytes) -> list[int]:
        return self._tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, and their bounds."""
        if not self._plain:  # rules that the cutting does not repeat: whole texts by the library
            raw = data.tobytes()
            found = [self._chunk(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            bounds = np.cumsum([0, *map(len, found)])
            return np.fromiter((i for f in found for i in f), np.uint32, int(bounds[-1])), bounds
        if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:
            parts = [self._encode(data[a:b], np.array([0, b - a]))[0] for a, b in blank_cuts(data)]
            ids = np.concatenate(parts)
            return ids, np.array([0, len(ids)])
        return self._encode(data, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        lower, starts, ends, odd = split_pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        sizes = ends - starts
        short = np.flatnonzero(~odd & (sizes <= _PIECE))
        counts = np.zeros(len(starts), np.int64)

        # short pieces: three words each, looked up in the table
        padded = np.concatenate([lower, np.zeros(_PIECE, np.uint8)])
        words = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        s, size = starts[short], sizes[short]
        keys = [words[s + 8 * i] & _MASK[np.clip(size - 8 * i, 0, 8)] for i in range(3)]
        code = mix64(keys[0] * _MIX[0] + mix64(keys[1] * _MIX[1] + keys[2] * _MIX[2]))
        slot = (code >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        hit = self._len[slot] > 0
        for i in range(3):
            hit &= self._keys[i][slot] == keys[i]
        known, new = np.flatnonzero(hit), np.flatnonzero(~hit)
        counts[short[known]] = self._len[slot[known]]
        _, one, which = np.unique(code[new], return_index=True, return_inverse=True)
        one = new[one]
        if any((keys[i][new] != keys[i][one][which]).any() for i in range(3)):  # equal codes of other pieces
            one, which = new, np.arange(len(new))
        found = [self._piece(lower[a:a + b].tobytes()) for a, b in zip(s[one].tolist(), size[one].tolist())]
        new_len = np.fromiter(map(len, found), np.int64, len(found))
        new_ids = np.fromiter((i for f in found for i in f), np.uint32, int(new_len.sum()))
        new_at = np.cumsum(new_len) - new_len
        counts[short[new]] = new_len[which]

        # odd chunks and longer pieces, one at a time
        rest = np.flatnonzero(odd | (sizes > _PIECE))
        rest_ids = [self._chunk(data[starts[i]:ends[i]].tobytes()) if odd[i]
                    else self._piece(lower[starts[i]:ends[i]].tobytes()) for i in rest.tolist()]
        counts[rest] = np.fromiter(map(len, rest_ids), np.int64, len(rest_ids))

        bounds = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(bounds[-1], np.uint32)
        at, many = short[known], counts[short[known]]
        ids[ragged(bounds[at], many)] = self._ids.ravel()[ragged(slot[known] * _KEPT, many)]
        at, many = short[new], counts[short[new]]
        ids[ragged(bounds[at], many)] = new_ids[ragged(new_at[which], many)]
        for i, f in zip(rest.tolist(), rest_ids):
            ids[bounds[i]:bounds[i + 1]] = f

        # new pieces take their slots; of two with one slot, the later stays
        place, last = np.unique(slot[one][::-1], return_index=True)
        keep = len(one) - 1 - last
        keep = keep[(new_len[keep] > 0) & (new_len[keep] <= _KEPT)]
        place = slot[one][keep]
        for i in range(3):
            self._keys[i][place] = keys[i][one][keep]
        self._len[place] = new_len[keep]
        self._ids.ravel()[ragged(place * _KEPT, new_len[keep])] = new_ids[ragged(new_at[keep], new_len[keep])]
        return ids, bounds[np.searchsorted(starts, offsets)]
