"""op1 and op10: ids against the libraries, pieces against whole documents."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import LONG, ODD_TEXTS
from tidystar.llm import byte_bpe, packing, word_bpe
from tidystar.llm.common import text_buffers, tokenizer_path

RANKS = tokenizer_path("byte_bpe_multi_50k.tiktoken")
WORDS = tokenizer_path("word_bpe_49k.json")
PIECES = ["a", "B", "É", "é", "ß", "'", "'s", "'t", "<|endoftext|>", "<", "|", " ", "  ", "\n", "\t", "1", "22", "½", "-",
          "...", "中", "ñ", "́", "İ", "Σ", "😀", "\x1c", "\x00", "×", "÷", "ÿ", "Ÿ", "ÀÈ", "　", "\u0085", "ǅ",
          "supercalifragilisticexpialidocious"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
                             special_tokens={})


def test_byte_bpe_of_odd_documents(odd_docs, library):
    coded = byte_bpe.encode(odd_docs, RANKS, public_tokenizers.PATTERN, ["doc_id"])
    rows = byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN) \
        .select("doc_id", "ids", byte_bpe.ids_digest().alias("sha"), "decoded").collect()
    texts = [*ODD_TEXTS, "no id at all", "one", LONG]
    assert len(rows) == len(texts)
    for row, text in zip(rows, texts):
        assert row["ids"] == library.encode_ordinary(text or "")
        assert bytes(row["decoded"]) == (text or "").encode()
        assert row["sha"] == hashlib.sha256(",".join(map(str, row["ids"])).encode()).hexdigest()


def test_byte_bpe_pieces_join_to_the_whole(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 5)
    monkeypatch.setattr(byte_bpe, "LONG_RUN", 3)
    monkeypatch.setattr(byte_bpe, "_RUN", byte_bpe.regex.compile(r"\s{3,}"))
    bpe, rng = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN), random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))
        assert bpe.encode(text) == library.encode_ordinary(text), text


def test_byte_bpe_long_white_space(library):
    bpe = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    text = "a" + " " * 200_000 + "b" + "\n" * 150_000
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_byte_bpe_empty_table(make_docs):
    coded = byte_bpe.encode(make_docs([]), RANKS, public_tokenizers.PATTERN, ["doc_id"])
    assert byte_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_bpe_equals_the_library():
    encoder, tokenizer, rng = word_bpe.BatchEncoder(WORDS), Tokenizer.from_file(WORDS), random.Random(1)
    for _ in range(60):
        texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, ""]
        ids, bounds = encoder.encode(*text_buffers(pa.array(texts, pa.string())))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_word_bpe_table_of_pieces_with_many_ids(monkeypatch):
    """Pieces met again, with more ids than the table keeps and in a table too small for them."""
    monkeypatch.setattr(word_bpe, "_SLOT_BITS", 4)
    encoder, tokenizer = word_bpe.BatchEncoder(WORDS), Tokenizer.from_file(WORDS)
    texts = ["qzxjvkqwzxjqvkzxwqjk and more", "the and of qzxjvk", "more of qzxjvkqwzxjqvkzxwqjk", None]
    most = max(len(tokenizer.encode(w, add_special_tokens=False).ids) for w in texts[0].split())
    assert most > word_bpe._KEPT
    for _ in range(3):
        ids, bounds = encoder.encode(*text_buffers(pa.array(texts, pa.string())))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def _check_pieces(pieces, expected):
    """Every id lies in exactly one piece; windows are gapless and not over long. Returns the padding."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    for (doc_id, tokens), own in by_doc.items():
        own.sort(key=lambda p: p["start"])
        copies = sum(1 for d, ids in expected if d == doc_id and len(ids) == tokens)
        assert sum(p["length"] for p in own) == copies * tokens
        ids = next(ids for d, ids in expected if d == doc_id and len(ids) == tokens)
        for p in own:
            part = np.array(ids[p["start"]:p["start"] + p["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == p["ids_crc32"]
    padding = 0
    for own in by_seq.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding


def test_packing_of_odd_documents(odd_docs):
    tokenizer = Tokenizer.from_file(WORDS)
    texts = [*zip(range(len(ODD_TEXTS)), ODD_TEXTS), (None, "no id at all"), (3, "one"), (99, LONG)]
    expected = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in texts]
    pieces = packing.pieces_digest(packing.pack_documents(odd_docs, WORDS)).collect()
    assert {(p["doc_id"], p["doc_tokens"]) for p in pieces} == {(d, len(ids)) for d, ids in expected}
    assert _check_pieces(pieces, expected) == 0


def test_packing_empty_table(make_docs):
    assert packing.pack_documents(make_docs([]), WORDS).count() == 0


def test_packer_holds_few_tokens_and_balances_groups():
    rng = np.random.default_rng(0)
    packer = packing.Packer(3, step_tokens=8192)
    expected = {}
    for d in range(3000):
        ids = rng.integers(0, 1000, int(rng.choice([5, 90, 300, 700, 1500, 6000]))).astype(np.uint32)
        expected[d] = ids
        packer.add(d, ids)
        assert sum(packer.held.values()) <= packing.HOLD * sum(packing.TIERS) + 2 * 2048
    packer.finish()
    got = {d: np.zeros(len(x), np.uint32) for d, x in expected.items()}
    groups = {}
    for d, at, n, raw, total, _, _, size, group in packer.rows:
        got[d][at:at + n] = np.frombuffer(raw, "<u4")
        groups[group] = groups.get(group, 0) + n
        assert size & (size - 1) == 0
    assert all((got[d] == x).all() for d, x in expected.items())
    assert sum(v == 8192 for v in groups.values()) >= len(groups) - 12


def test_pieces_digest_is_crc32(make_docs):
    rows = packing.pack_documents(make_docs([(1, "one two three")]), WORDS) \
        .select("ids", F.crc32("ids").alias("c")).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["c"] for r in rows)
