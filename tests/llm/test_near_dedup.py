"""op9 against brute force on whole shingle sets."""
import random
import re

import pytest

from tests.llm.conftest import LONG, ODD_TEXTS
from tidystar.llm import near_dedup


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else d
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=str)


def test_odd_documents(spark, odd_docs):
    rows = [*enumerate(ODD_TEXTS), (None, "no id at all"), (3, "one"), (99, LONG)]
    got = near_dedup.near_duplicates(spark, odd_docs, 2).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 2)


@pytest.mark.parametrize("k", [2, 5])
def test_families_of_near_copies(spark, make_docs, k):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(6):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 60, 150]))]
        for _ in range(25):
            copy = [rng.choice(words) if rng.random() < rng.choice([0, 0.01, 0.04, 0.08]) else w for w in base]
            rows.append((len(rows) * 7 % 1009, " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    got = near_dedup.near_duplicates(spark, make_docs(rows), k).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, k)


def test_chain_is_one_component(spark, make_docs):
    words = [f"w{i}" for i in range(130)]
    rows = [(i, " ".join(words[2 * i:2 * i + 60])) for i in range(30)]
    got = near_dedup.near_duplicates(spark, make_docs(rows), 2).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 2)
    assert {r["component_id"] for r in got} == {0}


def test_keep_one_per_group_keeps_all_columns(spark, odd_docs):
    kept = near_dedup.keep_one_per_group(spark, odd_docs, 2)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] for r in kept.collect()]
    # blank texts are linked with nothing; the two equal texts and the repeated row leave one each
    assert sorted(t or "" for t in texts) == sorted(
        t or "" for t in [*dict.fromkeys(ODD_TEXTS[3:]), *ODD_TEXTS[:3], "no id at all", LONG]
        if t not in ("one  two",))


def test_empty_table(spark, make_docs):
    assert near_dedup.near_duplicates(spark, make_docs([]), 2).count() == 0
    assert near_dedup.keep_one_per_group(spark, make_docs([]), 2).count() == 0


def brute_by_matrix(rows, k):
    """As ``brute``, with all intersections from one product of set matrices."""
    import numpy as np

    sets = [shingles(t, k) for _, t in rows]
    number = {g: i for i, g in enumerate(sorted(set().union(*sets)))}
    x = np.zeros((len(rows), len(number)), np.float32)
    for i, s in enumerate(sets):
        x[i, [number[g] for g in s]] = 1
    common, size = x @ x.T, x.sum(axis=1)
    linked = 100 * common >= 80 * (size[:, None] + size - common)
    label = np.arange(len(rows))
    while True:
        low = np.array([label[row].min() for row in linked])
        if (low == label).all():
            return {rows[i][0]: min(rows[j][0] for j in np.flatnonzero(label == label[i])) for i in range(len(rows))}
        label = low


@pytest.mark.parametrize("tile", [64, 4096])
def test_a_family_of_thousands_in_many_components(spark, make_docs, monkeypatch, tile):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(60)]
    texts = set()
    while len(texts) < 3000:
        copy = base.copy()
        for _ in range(rng.choice([1, 2, 4, 5, 6, 8])):
            copy[rng.randrange(60)] = f"v{rng.randrange(40)}"
        texts.add(" ".join(copy))
    rows = list(enumerate(sorted(texts)))
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark, make_docs(rows), 2).collect()}
    want = brute_by_matrix(rows, 2)
    assert got == want and len(set(want.values())) > 20
