"""op11, op12, op13: whole results against the libraries and brute force."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tests.llm.conftest import LONG, ODD_TEXTS
from tests.llm.test_tokens import PIECES
from tidystar.llm import periodic_runs, queries, token_alignment, word_transducer
from tidystar.llm.common import text_buffers, tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = [*zip(range(len(ODD_TEXTS)), ODD_TEXTS), (None, "no id at all"), (3, "one"), (99, LONG)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- op12 ----------------------------------------------------------------------
def brute_words(rows):
    library, out = Tokenizer.from_file(WORDS), []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_op12_query_equals_the_library(spark):
    assert rows_of(queries.op12_transducer_word_bpe(spark, SF001)) == brute_words(documents(spark))


@pytest.mark.parametrize("lexicon", [0, 5, 1 << 17])
def test_transducer_encodes_odd_documents(spark, odd_docs, lexicon):
    coded = word_transducer.encode(spark, odd_docs, WORDS, ["doc_id"], lexicon_words=lexicon)
    found = word_transducer.decode(coded, WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    got = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in found), key=repr)
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids) for d, t in ODD]
    assert got == sorted(((d, i, library.decode(i, skip_special_tokens=False)) for d, i in ids), key=repr)


def test_transducer_of_an_empty_table(spark, make_docs):
    coded = word_transducer.encode(spark, make_docs([]), WORDS, ["doc_id"])
    assert word_transducer.decode(coded, WORDS).count() == 0


def test_encoder_equals_the_library_on_random_texts():
    rules, rng = word_transducer.WordRules(WORDS), random.Random(8)
    lexicon = word_transducer.compile_lexicon(sorted({"the".encode(), "a".encode(), "supercalifrag".encode(), "é".encode(),
                                                      "½".encode(), "22".encode(), "...".encode()}), WORDS)
    encoder, library = word_transducer.Encoder(WORDS, lexicon), Tokenizer.from_file(WORDS)
    pieces = [*PIECES, "<|startoftext|>", "the", "supercalifrag"]
    for _ in range(40):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(40)] + [None, ""]
        ids, bounds = encoder.encode(*text_buffers(pa.array(texts, pa.string())))
        for i, t in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids, t
    assert rules.merge(b"x" * 5000) == tuple(library.encode("x" * 5000, add_special_tokens=False).ids)


def test_transducer_is_minimal_and_exact():
    rng = random.Random(4)
    entries = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))): tuple(rng.choices((1, 2, 3), k=rng.randint(1, 3)))
               for _ in range(300)}
    states = word_transducer.minimal_transducer(sorted(entries.items()))
    assert len(set(states)) == len(states)  # no two states accept the same suffixes with the same ids
    # every path gives its word's ids
    paths = {(): (states[-1], ())}
    found = {}
    while paths:
        word, ((final, arcs), ids) = paths.popitem()
        if final is not None:
            found[bytes(word)] = ids + final
        paths.update({(*word, b): (states[t], ids + o) for b, t, o in arcs})
    assert found == entries
    # as flat arrays
    flat = word_transducer.Transducer(word_transducer.flatten(states))
    words = [*entries, b"", b"cccccccc", b"d", b"a" * 40]
    data = np.frombuffer(b"".join(words) + bytes(32), np.uint8)
    sizes = np.array([len(w) for w in words])
    accepted, counts, ids = flat.ids(data, np.cumsum(sizes) - sizes, sizes)
    assert [w for w, ok in zip(words, accepted) if ok] == list(entries)
    ends = np.cumsum(counts)
    assert all(tuple(ids[e - n:e]) == entries.get(w, ()) for w, e, n in zip(words, ends, counts))
    # a shared suffix is stored once: four words, one path for "ing"
    shared = word_transducer.minimal_transducer([(b"aing", (1,)), (b"bing", (2,)), (b"cing", (3,)), (b"ding", (4,))])
    assert len(shared) == 5


def test_frequent_words_are_those_counted_most(spark, make_docs):
    docs = make_docs([(1, "a a a b"), (2, "a b c"), (3, None), (4, "x" * 50)])
    counts = word_transducer.word_counts(docs, WORDS)
    assert {bytes(r["word"]): r["n"] for r in counts.collect()} == {b"a": 4, b"b": 2, b"c": 1}
    assert word_transducer.frequent_words(counts, 2) == [b"a", b"b"]
    assert word_transducer.frequent_words(counts, 0) == []


# --- op11 ----------------------------------------------------------------------
class Brute:
    def __init__(self):
        self.a, self.b = token_alignment.TokenizerA(A_PATH), token_alignment.TokenizerB(B_PATH)

    def links(self, text):
        """(ids of A, ids of B, groups, links) of a whole text by comparing all byte ranges; None if bytes differ."""
        a, b = self.a.encode([" " + text])[0], self.b.encode([text])[0]
        sides = []
        for ids, side in ((a, self.a), (b, self.b)):
            raw = [side.token_bytes[i] for i in ids]
            if b"".join(raw) != (" " + text).encode():
                return None
            sides.append(np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
        x, y = sides
        lo, hi = np.maximum(x[:-1, None], y[None, :-1]), np.minimum(x[1:, None], y[None, 1:])
        links = Counter((a[i], b[j]) for i, j in zip(*np.nonzero(lo < hi)))
        groups, last = [], 0
        for end in sorted(set(x[1:].tolist()) & set(y[1:].tolist())):
            groups.append(",".join(str(i) for i, e in zip(a, x[1:]) if last < e <= end) + "|"
                          + ",".join(str(i) for i, e in zip(b, y[1:]) if last < e <= end))
            last = end
        return a, b, groups, links

    def table(self, rows):
        found = [(d, self.links(t) if t else None) for d, t in rows]
        count = Counter()
        for _, f in found:
            count.update(f[3] if f else {})
        best = {}
        for (_, b), n in count.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for d, f in found:
            if f is None:
                out.append((d, 0, 0, 0, 0, 0, 0, ""))
                continue
            a, b, groups, links = f
            out.append((d, len(a), len(b), len(groups), sum(links.values()),
                        sum(n for p, n in links.items() if count[p] == best[p[1]]),
                        sum(n * count[p] for p, n in links.items()), sha(";".join(groups))))
        return sorted(out, key=repr)


def test_op11_query_equals_brute_force(spark):
    rows = [(d, t) for d, t in documents(spark) if len(t or "") < 1500]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("text IS NULL OR length(text) < 1500")
    assert rows_of(token_alignment.align_tokenizers(spark, docs, A_PATH, B_PATH)) == Brute().table(rows)
    assert queries.op11_exact_text_alignment(spark, SF001).count() == len(documents(spark))


def test_alignment_of_odd_documents(spark, make_docs, monkeypatch):
    texts = [*ODD_TEXTS, "a▁b stays out", " ", "  two  blanks ", "\n", "ends blank ", " nbsp  here", "<0x41> <s>"]
    rows = [*enumerate(texts), (None, "no id at all"), (3, "one"), *((i, "copy of it") for i in range(200, 230))]
    monkeypatch.setattr(token_alignment, "HOT", 3)  # the copies are broadcast, the rest is shuffled
    found = rows_of(token_alignment.align_tokenizers(spark, make_docs(rows), A_PATH, B_PATH))
    assert found == Brute().table(rows)


def test_alignment_of_an_empty_table(spark, make_docs):
    assert token_alignment.align_tokenizers(spark, make_docs([]), A_PATH, B_PATH).count() == 0


def test_stretches_align_as_whole_texts(monkeypatch):
    aligner, brute, rng = token_alignment.Aligner(A_PATH, B_PATH), Brute(), random.Random(3)
    monkeypatch.setattr(token_alignment, "PART_CHARS", 20)
    monkeypatch.setattr(token_alignment, "MEMO", 500)
    pieces = [*PIECES, "<s>", "<0x41>", "▁", " ", " ", "token", "ization", " ", "ﬁ"]
    for _ in range(60):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(20)]
        for text, got in zip(texts, aligner.measure(texts)):
            want = brute.links(text)
            if want is None:
                assert got[:5] == (0, 0, 0, 0, "")
                continue
            a, b, groups, links = want
            assert got[:5] == (len(a), len(b), len(groups), sum(links.values()), sha(";".join(groups))), text
            assert dict(zip(got[5].tolist(), got[6].tolist())) == {(x << 32) | y: n for (x, y), n in links.items()}


def test_very_long_text_is_aligned_in_parts():
    aligner = token_alignment.Aligner(A_PATH, B_PATH)
    text = LONG[:3_000_000]
    got, want = aligner.measure([text])[0], aligner._whole(text)
    assert got[:5] == want[:5] and (got[5] == want[5]).all() and (got[6] == want[6]).all()


# --- op13 ----------------------------------------------------------------------
def brute_runs(words, least_length=6, least_exponent=4):
    """{(start, end): period} by walking every period."""
    found, n = {}, len(words)
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least_length, least_exponent * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_run_rows(rows):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha(listed),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_op13_query_equals_brute_force(spark):
    rows = [(d, t) for d, t in documents(spark) if len((t or "").split()) < 3000]
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where("size(split(text, '[ \\\\t-\\\\r]+')) < 3000")
    kept = {d for d, _ in rows} & {r["doc_id"] for r in docs.select("doc_id").collect()}
    found = queries.op13_branching_tandem_runs(spark, SF001)
    got = sorted((tuple(r) for r in found.collect() if r["doc_id"] in kept), key=repr)
    assert got == brute_run_rows([(d, t) for d, t in rows if d in kept])
    assert sum(r[1] > 0 for r in got) > 5


def test_runs_of_odd_documents(spark, make_docs):
    texts = [*ODD_TEXTS, "a " * 50, "a b " * 9 + "c", "x\ty\nx\vy\fx\ry X Y x y", "one two " * 4 + "two " * 6, "a b c " * 4]
    rows = [*enumerate(texts), (None, "b " * 8), (3, "one"), *((i, "p q r s t " * 12) for i in range(100, 160))]
    found = periodic_runs.find_runs(make_docs(rows), arrange=periodic_runs.planted)
    got = rows_of(periodic_runs.runs_digest(found))
    assert got == brute_run_rows(rows)


def test_runs_of_an_empty_table(make_docs):
    assert periodic_runs.runs_digest(periodic_runs.find_runs(make_docs([]))).count() == 0


@pytest.mark.parametrize("length,exponent", [(6, 4), (2, 2)])
def test_runs_equal_brute_force_on_random_words(length, exponent):
    rng = random.Random(length)
    for _ in range(150):
        docs = [[rng.randrange(k) for _ in range(rng.randint(0, 60))] for k in rng.choices((1, 2, 3, 20), k=5)]
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        found = periodic_runs.runs(np.array([w for d in docs for w in d], np.int32), bounds, length, exponent)
        got = [[] for _ in docs]
        for d, *run in zip(*(x.tolist() for x in found)):
            got[d].append(tuple(run))
        assert got == [brute_runs(d, length, exponent) for d in docs]


def test_runs_of_long_repetitive_words():
    n = 300_000
    for words, want in ((np.zeros(n, np.int32), (0, n, 1)), (np.arange(n, dtype=np.int32) % 1000, (0, n, 1000))):
        found = periodic_runs.runs(words, np.array([0, n]))
        assert [tuple(x.tolist()) for x in found[1:]] == [(v,) for v in want]
