"""Near-duplicate groups by b-bit MinHash, confirmed on whole shingle sets.

A document's set holds its distinct word shingles. Documents with equal sets
form a class (one 128-bit key); everything after the first pass works on one
row per class, so large groups of copies cost one row each.

1. One narrow pass hashes the words of whole texts and keeps, per document, the
   set size, the class key, the low bits of ``N_HASHES`` minima packed into
   longs (b-bit MinHash) and ``BANDS`` band keys.
2. Classes that share a band key are candidates. Per band key every class is
   paired with the key's most central class, the one that meets most others
   over all its keys (linear, not all pairs).
3. A pair survives if its set sizes allow the threshold and its
   collision-corrected b-bit estimate is at least ``threshold - MARGIN``; both
   are bit operations inside Spark.
4. Survivors are confirmed on full sets. Components of confirmed links follow by
   distributed minimum-label propagation with pointer jumping.
5. Classes that met the same central class but still lie in different components
   are searched for links, in tiles of bounded size: pairs are tested by estimate and
   full sets inside the join, and only links leave it; components are then closed.

With 24 bands of 4 rows (the first 96 minima) a pair of similarity 0.8 shares no
band with probability 3e-6, and the margin is more than 4 standard deviations of
the estimate from 512 minima.

Defined results: NULL, empty or blank text gives 0 shingles, its own component,
kept. A NULL ``doc_id`` never becomes a ``component_id`` unless its whole
component has none; then ``component_id`` is NULL and its rows count as kept.
Rows that repeat a ``doc_id`` are each processed. Other input columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidystar.llm.common import (SLICE_BYTES, annotate, blank_cuts, cut_lineage,
                                 fresh_name, is_blank, join_hot, mix64, seeded_words, slices,
                                 text_buffers)

N_HASHES = 512
BANDS = 24
ROWS = 4
BITS = 2
#: How far below the threshold a b-bit estimate may lie before a pair is dropped.
MARGIN = 0.09
#: Text bytes hashed at a time; the arrays of the hashing take many times as many.
HASHED_BYTES = SLICE_BYTES // 4
#: Classes of a head in one tile of the search across components.
TILE = 256
_WORDS64 = N_HASHES * BITS // 64
_SIG = [f"s{i}" for i in range(_WORDS64)]

_BYTE = seeded_words(11, 256)
_POLY = seeded_words(12, 1, odd=True)[0]
_POLY_INV = np.uint64(pow(int(_POLY), -1, 1 << 64))
_ORDER = seeded_words(13, 64, odd=True)
_XOR = seeded_words(14, N_HASHES)
_MUL = seeded_words(15, N_HASHES, odd=True)
_ROWMIX = seeded_words(16, ROWS, odd=True)
_BANDMIX = seeded_words(17, BANDS)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _POLY), ("down", _POLY_INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words begin.

    Words are runs of bytes other than space and TAB..CR, with A-Z lower-cased.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if len(offsets) == 2 and n > 2 * SLICE_BYTES:  # one very long text: piece by piece
        found = [_hashes(data[a:b], np.array([0, b - a]))[0] for a, b in blank_cuts(data)]
        words = np.concatenate(found)
        return words, np.array([0, len(words)])
    return _hashes(data, offsets)


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~is_blank(data)
    first = np.ones(n, bool)
    first[1:] = ~inside[:-1]
    first[offsets[:-1][offsets[:-1] < n]] = True
    last = np.ones(n, bool)
    last[:-1] = first[1:] | ~inside[1:]
    first &= inside
    last &= inside
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lower = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    up, down = _powers(n)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(_BYTE[lower] * up[:n], out=prefix[1:])
    words = (prefix[ends] - prefix[starts]) * down[starts]
    words = mix64(words + (ends - starts).astype(np.uint64))
    return words, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``k``-word shingles (a shorter text is one shingle) and their bounds per text."""
    counts = np.diff(bounds)
    n_sh = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(n_sh)])
    doc = np.repeat(np.arange(len(counts)), n_sh)
    at = np.arange(out_bounds[-1]) - out_bounds[doc] + bounds[doc]
    end = bounds[doc + 1]
    acc = np.zeros(len(at), np.uint64)
    for j in range(k):
        pos = at + j
        ok = pos < end
        acc += np.where(ok, words[np.minimum(pos, max(len(words) - 1, 0))] * _ORDER[j], np.uint64(0))
    return mix64(acc + np.minimum(counts, k)[doc].astype(np.uint64)), out_bounds


def distinct_sets(shingles: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, concatenated, and their bounds."""
    parts, sizes = [], np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            x = np.sort(shingles[a:b])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
            parts.append(x)
            sizes[i] = len(x)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def class_keys(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 128-bit key of each non-empty set, as an (n, 2) array."""
    heads = bounds[:-1]
    sizes = np.diff(bounds).astype(np.uint64)
    a = np.add.reduceat(mix64(flat ^ _XOR[0]), heads)
    b = np.add.reduceat(mix64(flat ^ _XOR[1]), heads)
    return np.stack([mix64(a + sizes), mix64(b ^ (sizes * _MUL[0]))], axis=1)


def minima(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(N_HASHES, n) 32-bit minima of the non-empty sets."""
    out = np.empty((N_HASHES, len(bounds) - 1), np.uint64)
    work = np.empty_like(flat)
    for i in range(N_HASHES):
        np.bitwise_xor(flat, _XOR[i], out=work)
        np.multiply(work, _MUL[i], out=work)
        out[i] = np.minimum.reduceat(work, bounds[:-1])
    out >>= np.uint64(32)
    return out


def pack_bits(mins: np.ndarray) -> np.ndarray:
    """The low ``BITS`` of every minimum, packed into (n, longs)."""
    per = 64 // BITS
    low = mins & np.uint64((1 << BITS) - 1)
    out = np.zeros((_WORDS64, mins.shape[1]), np.uint64)
    for i in range(N_HASHES):
        out[i // per] |= low[i] << np.uint64(BITS * (i % per))
    return out.T


def band_keys(mins: np.ndarray) -> np.ndarray:
    out = np.empty((BANDS, mins.shape[1]), np.uint64)
    for j in range(BANDS):
        acc = np.full(mins.shape[1], _BANDMIX[j])
        for r in range(ROWS):
            acc = mix64(acc + mins[j * ROWS + r] * _ROWMIX[r])
        out[j] = acc
    return out.T


def _sets(column: pa.Array, k: int):
    data, offsets = text_buffers(column)
    words, bounds = word_hashes(data, offsets)
    flat, sets = distinct_sets(*shingle_hashes(words, bounds, k))
    sizes = np.diff(sets)
    full = np.flatnonzero(sizes)
    return sizes, full, flat, np.concatenate([sets[:-1][full], sets[-1:]])


def _nodes(keys: np.ndarray, full: np.ndarray, n: int) -> pa.Array:
    raw = np.ascontiguousarray(keys).tobytes()
    values: list = [None] * n
    for j, i in enumerate(full.tolist()):
        values[i] = raw[16 * j:16 * j + 16]
    return pa.array(values, pa.binary())


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, set size, class key, packed low bits, band keys."""
    def run(batches):
        for batch in slices(batches, "text", HASHED_BYTES):
            sizes, full, flat, bounds = _sets(batch.column("text"), k)
            n = len(sizes)
            sig, bands = np.zeros((n, _WORDS64), np.int64), [None] * n
            keys = np.zeros((0, 2), np.uint64)
            if len(full):
                keys, mins = class_keys(flat, bounds), minima(flat, bounds)
                sig[full] = pack_bits(mins).view(np.int64)
                for i, row in zip(full.tolist(), band_keys(mins).view(np.int64)):
                    bands[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), _nodes(keys, full, n)]
                + [pa.array(np.ascontiguousarray(sig[:, i])) for i in range(_WORDS64)]
                + [pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "node", *_SIG, "bands"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_shingles bigint, node binary, "
              + ", ".join(f"{s} bigint" for s in _SIG) + ", bands array<bigint>")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, schema)


def class_sets(docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of ``docs`` (columns doc_id, text): the sorted distinct hashes."""
    def run(batches):
        for batch in slices(batches, "text", HASHED_BYTES):
            _, full, flat, bounds = _sets(batch.column("text"), k)
            if len(full):
                yield pa.RecordBatch.from_arrays(
                    [_nodes(class_keys(flat, bounds), np.arange(len(full)), len(full)),
                     pa.LargeListArray.from_arrays(bounds, flat.view(np.int64)).cast(pa.list_(pa.int64()))],
                    names=["node", "shingles"])

    return docs.select("text").mapInArrow(run, "node binary, shingles array<bigint>")


def estimate_passes(a: str, b: str, threshold: float):
    """Size bound and collision-corrected b-bit estimate of two class rows."""
    ones = sum(1 << i for i in range(0, 64, BITS))
    differ = F.lit(0)
    for s in _SIG:
        y = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        y = y.bitwiseOR(F.shiftrightunsigned(y, 1))  # BITS is 2
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(ones)))
    most = N_HASHES * (1 - (threshold - MARGIN)) * (1 - 2.0 ** -BITS)
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    pct = round(100 * threshold)
    return (100 * F.least(na, nb) >= pct * F.greatest(na, nb)) & (differ <= F.lit(int(most)))


def _star_pairs(buckets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Every class with the central class of each of its band keys, filtered."""
    pairs = buckets.where(F.col("node") != F.col("head")) \
        .select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
    cls = classes.select("node", "n_shingles", *_SIG)
    return (pairs.join(cls.alias("x"), F.col("a") == F.col("x.node"))
            .join(cls.alias("y"), F.col("b") == F.col("y.node"))
            .where(estimate_passes("x", "y", threshold)).select("a", "b"))


def _cross_links(spark: SparkSession, docs: DataFrame, buckets: DataFrame, classes: DataFrame, labels: DataFrame,
                 k: int, threshold: float) -> DataFrame | None:
    """Links between classes that met the same central class but lie in different components.

    A pair across components has a stray: a class that is not in its centre's component. So
    only strays ask, and only heads with strays are looked at. Askers and asked of a head
    are dealt to tiles of about ``TILE`` rows, and each pair of tiles is a join key of its own,
    so a head of any size spreads over many tasks. Pairs are tested where they meet and
    only links leave the join; a semi join by the estimate tells first which classes bring
    their sets.
    """
    met = buckets.where("n > 2").select("head", "node").distinct()
    heads = met.groupBy("head").agg(F.count("*").alias("size")) \
        .join(labels.select(F.col("node").alias("head"), F.col("label").alias("main")), "head", "left") \
        .select("head", "size", F.coalesce("main", "head").alias("main"))
    rows = met.join(labels, "node", "left").select("head", "node", F.coalesce("label", "node").alias("comp"))
    rows = cut_lineage(spark, join_hot(rows, heads, "head", "size"), "met")
    strays = rows.where("comp != main").groupBy("head").agg(F.count("*").alias("strays"), F.first("size").alias("size"))
    strays = cut_lineage(spark, strays, "strays")
    if strays.isEmpty():
        return None
    rows = join_hot(rows.drop("size"), strays, "head", "size") \
        .join(classes.select("node", "n_shingles", *_SIG), "node")
    rows = cut_lineage(spark, rows, "mixed")

    def tile(rows_of: str, seed: int):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.ceil(F.col(rows_of) / TILE)).alias

    def every(rows_of: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col(rows_of) / TILE) - 1)).alias

    def tiles(found: DataFrame) -> tuple[DataFrame, DataFrame, object]:
        """Askers, asked, and when two of them are a pair across components."""
        x = found.where("comp != main").select("*", tile("strays", 1)("tx"), every("size")("ty")).alias("x")
        y = found.select("*", tile("size", 2)("ty"), every("strays")("tx")).alias("y")
        same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("head", "tx", "ty")]
        return x, y, same[0] & same[1] & same[2] & (F.col("x.comp") != F.col("y.comp"))

    x, y, pair = tiles(rows)
    pair = pair & estimate_passes("x", "y", threshold)
    near = cut_lineage(spark, x.join(y, pair, "left_semi").select("node")
                       .union(y.join(x, pair, "left_semi").select("node")).distinct(), "near")
    if near.isEmpty():
        return None
    sets = cut_lineage(spark, _sets_of(docs, classes, near, k), "sets").dropDuplicates(["node"])
    x, y, pair = tiles(rows.join(sets, "node"))
    pct = round(100 * threshold)
    common = F.size(F.array_intersect("x.shingles", "y.shingles"))
    linked = (100 + pct) * common >= pct * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    return (x.join(y, pair & estimate_passes("x", "y", threshold) & linked)
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())


def _sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) of the documents that stand for the classes ``nodes`` (and perhaps others of their ids)."""
    reps = classes.join(nodes, "node", "left_semi").select(F.col("doc_id").alias("rep")).distinct()
    return class_sets(docs.join(reps, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi"), k)


def confirm(spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int,
            threshold: float) -> DataFrame:
    """The pairs of class keys whose full sets reach the threshold.

    ``docs`` has doc_id and text. Only documents that stand for a class of some
    pair are read into sets.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = cut_lineage(spark, _sets_of(docs, classes, nodes, k), "sets").dropDuplicates(["node"])
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
            .withColumn("common", common)
            .where(100 * F.col("common") >= round(100 * threshold) * union).select("a", "b"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for the nodes of ``edges`` (a, b).

    Each round takes the smallest label among the neighbours, then jumps to that
    label's own label; the rounds are written to the shared folder and end when
    no label changes.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")) \
        .union(edges.select(F.col("b"), F.col("a")))
    labels = cut_lineage(
        spark, both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("l2")), "other") \
            .groupBy("node").agg(F.min("l2").alias("l2"))
        step = labels.join(near, "node") \
            .select("node", F.col("label").alias("old"), F.least("label", "l2").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("l3"))
        step = cut_lineage(spark, step.join(jump, "to", "left").select(
            "node", "old", F.least("to", "l3").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def near_duplicate_classes(spark: SparkSession, docs: DataFrame, shingle_words: int = 5,
                           threshold: float = 0.8, id_col: str = "doc_id",
                           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, classes).

    documents: doc_id, n_shingles, node (class key; NULL for an empty set).
    classes: node, label (component key), component_id (smallest doc_id of it).
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sig = cut_lineage(spark, signatures(docs, shingle_words, "doc_id", "text"), "signatures")
    same = [F.first(c).alias(c) for c in ("n_shingles", *_SIG, "bands")]
    classes = cut_lineage(spark, sig.where("node IS NOT NULL").groupBy("node")
                          .agg(F.min("doc_id").alias("doc_id"), *same), "classes")
    posted = classes.select("node", F.explode("bands").alias("key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = cut_lineage(spark, posted.join(shared, "key"), "buckets")
    central = buckets.groupBy("node").agg(F.sum("n").alias("met"))
    heads = buckets.join(central, "node").groupBy("key") \
        .agg(F.max(F.struct("met", "node")).alias("top")).select("key", F.col("top.node").alias("head"))
    buckets = cut_lineage(spark, buckets.join(heads, "key"), "headed")
    stars = cut_lineage(spark, _star_pairs(buckets, classes, threshold), "stars")
    edges = cut_lineage(spark, confirm(spark, docs, classes, stars, shingle_words, threshold), "edges")
    labels = components(spark, edges)
    more = _cross_links(spark, docs, buckets, classes, labels, shingle_words, threshold)
    if more is not None:
        labels = components(spark, cut_lineage(spark, edges.union(more), "edges"))
    named = classes.select("node", "doc_id").join(labels, "node", "left") \
        .select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    named = cut_lineage(spark, named, "components")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return sig.select("doc_id", "n_shingles", "node"), \
        named.select("node", "label").join(least, "label")


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle_words: int = 5,
                    threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    rows, classes = near_duplicate_classes(spark, docs, shingle_words, threshold, id_col, text_col)
    linked = rows.where("node IS NOT NULL").join(classes, "node") \
        .select("doc_id", "n_shingles", "component_id")
    alone = rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one_per_group(spark: SparkSession, docs: DataFrame, shingle_words: int = 5,
                       threshold: float = 0.8) -> DataFrame:
    """The documents (all their columns) with one document of each near-duplicate group.

    The smallest doc_id of a group stays; if several rows of a group carry it
    (or it is NULL), one of them does. Documents without words
    are all kept.
    """
    rows, classes = near_duplicate_classes(spark, docs, shingle_words, threshold)
    stay = rows.where("node IS NOT NULL").join(classes, "node") \
        .where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("label").agg(F.min("node").alias("node"), F.first("doc_id").alias("doc_id"))
    key = fresh_name(docs, "class_key")
    tagged = with_class_key(docs, shingle_words, key)
    kept = tagged.alias("d").join(
        stay.alias("s"), (F.col(f"d.{key}") == F.col("s.node")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")),
        "left_semi").dropDuplicates([key, "doc_id"])
    return kept.union(tagged.where(F.col(key).isNull())).drop(key)


def with_class_key(docs: DataFrame, k: int, name: str) -> DataFrame:
    """The documents with their class key added as ``name``."""
    def make():
        def run(column):
            sizes, full, flat, bounds = _sets(column, k)
            keys = class_keys(flat, bounds) if len(full) else np.zeros((0, 2), np.uint64)
            return [_nodes(keys, full, len(sizes))]

        return run

    return annotate(docs, "text", docs.columns, f"{name} binary", make)
