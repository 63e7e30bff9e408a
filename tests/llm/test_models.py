"""op2, op5 and the pipeline: held-out accuracy and defined results."""
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import LONG, ODD_TEXTS
from tests.llm.test_near_dedup import brute
from tidystar.llm import language_id, near_dedup, packing, quality, queries
from tidystar.llm.common import read_table, small_batches, tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def language_model(documents):
    return language_id.fit(documents, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)


def test_language_of_held_out_documents(spark, documents):
    got = queries.queries()["op2_byte_cnn_language_id"](spark, SF).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and len(held) > 250
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_tables_give_what_the_filters_give(language_model):
    """Looked-up windows equal the network computed directly."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, language_id.N_SYMBOLS, (20, language_id.WINDOW + 3)).astype(np.uint8)
    x[:, language_id.WINDOW:] = 0
    e = language_model.embed[x]
    direct = []
    for w, k in zip(language_id.WIDTHS, language_model.filters):
        patch = np.concatenate([e[:, j:j + language_id.WINDOW] for j in range(w)], axis=2)
        direct.append((patch @ k.reshape(-1, language_id.FILTERS)).max(axis=1))
    direct = np.maximum(np.concatenate(direct, axis=1) + language_model.bias, 0)
    assert np.allclose(language_id.Scorer(language_model).features(x), direct, atol=1e-4)


def test_language_of_odd_documents(odd_docs, language_model):
    got = language_id.predict(odd_docs, language_model, ["doc_id", "text"]).collect()
    assert len(got) == len(ODD_TEXTS) + 3
    for row in got:
        lettered = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not lettered)
        assert row["score"] == 0 if not lettered else 0 < row["score"] <= 1
    empty = language_id.predict(odd_docs.limit(0), language_model, ["doc_id"])
    assert empty.count() == 0


def test_language_without_labels(odd_docs):
    model = language_id.fit(odd_docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(odd_docs, model, ["doc_id"]).collect()} == {("und", 0.0)}


def test_a_rare_label_is_learned(documents, make_docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in documents.where("lang IN ('en', 'de')").collect()]
    german = [r for r in rows if r[2] == "de"]
    rare = german[0][0]
    docs = make_docs([r for r in rows if r[2] == "en" or r[0] == rare])
    model = language_id.fit(docs, F.lit(True))
    got = language_id.predict(make_docs(german[1:]), model, ["doc_id"]).collect()
    assert np.mean([r["lang_pred"] == "de" for r in got]) >= 0.95


def test_every_label_is_learned_however_many(make_docs, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCS", 100)  # fewer than labels: one document of each
    rows = [(i, f"some words {i} of it", f"l{i % 300:03}") for i in range(900)] + [(1000, "x y", "und"), (1001, "x", None)]
    model = language_id.fit(make_docs(rows), F.lit(True), epochs=1)
    assert model.labels == [f"l{i:03}" for i in range(300)]
    got = language_id.predict(make_docs(rows[:5]), model, ["doc_id"]).collect()
    assert all(r["lang_pred"] in model.labels and 0 < r["score"] <= 1 for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 300])
def test_language_bound_can_reject_for_any_number_of_labels(n):
    least = corpus_pipeline.least_language_score(n)
    assert (least == 1) if n == 1 else 1 / n < least < 1 / n + 0.1


def test_uncertain_texts_are_rejected(spark, make_docs, monkeypatch):
    """With two labels the bound lies above one half: text that is as much of one as of the other goes."""
    flat = language_id.LanguageModel(["a", "b"], *(np.zeros_like(x) if not isinstance(x, list) else [np.zeros_like(y) for y in x]
                                                   for x in _tiny_network()))
    monkeypatch.setattr(language_id, "fit", lambda docs, learn: flat)
    assert corpus_pipeline.keep_identified(spark, make_docs([(1, "some words")]), SF).count() == 0


def _tiny_network():
    width = len(language_id.WIDTHS) * language_id.FILTERS
    return (np.zeros((language_id.N_SYMBOLS, language_id.EMBED)),
            [np.zeros((w, language_id.EMBED, language_id.FILTERS)) for w in language_id.WIDTHS],
            np.zeros(width), np.zeros((width, 2)), np.zeros(2))


def test_ridge_weights_equal_a_direct_solution(spark, documents):
    """The partition-summed normal equations against one least-squares problem over all labelled rows."""
    labels = read_table(spark, SF, "labels")
    model = quality.fit(spark, documents, labels, F.lit(True))
    marked = {r["doc_id"]: float(r["quality"]) for r in labels.where("quality IS NOT NULL").collect()}
    rows = [r for r in documents.select("doc_id", "text").collect() if r["doc_id"] in marked]
    z = model.features(quality.document_stats(pa.array([r["text"] for r in rows]))) / quality._SCALE
    y = np.array([marked[r["doc_id"]] for r in rows])
    n, width = z.shape
    # the penalty as rows of their own, none for the constant
    ridge = np.sqrt(quality.RIDGE * n) * np.eye(width)[:-1]
    direct = np.linalg.lstsq(np.concatenate([z, ridge]), np.concatenate([y, np.zeros(width - 1)]), rcond=None)[0]
    assert np.allclose(z @ direct, z @ model.weights, atol=1e-6)


def test_quality_of_held_out_documents(spark):
    got = queries.queries()["op5_fourier_quality"](spark, SF).join(read_table(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in held]) >= 0.9
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) >= 0.97
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)


def test_quality_does_not_depend_on_partitions(spark, documents):
    labels = read_table(spark, SF, "labels")
    one = quality.fit(spark, documents.coalesce(1), labels, F.lit(True))
    many = quality.fit(spark, documents.repartition(7), labels, F.lit(True))
    assert (one.weights == many.weights).all() and (one.curve_y == many.curve_y).all()


def test_quality_of_odd_documents(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(13)] + [(None, 1, 0), (3, None, 1), (3, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    model = quality.fit(spark, odd_docs, labels, F.lit(True))
    got = quality.score(odd_docs, model, ["doc_id"]).collect()
    assert len(got) == len(ODD_TEXTS) + 3 and all(0 <= r["score"] <= 1 for r in got)
    none = quality.fit(spark, odd_docs, labels.limit(0), F.lit(True))
    assert {r["score"] for r in quality.score(odd_docs, none, ["doc_id"]).collect()} == {0.5}
    assert quality.score(odd_docs.limit(0), model, ["doc_id"]).count() == 0


def test_statistics_of_long_and_empty_texts():
    stats = quality.document_stats(pa.array([None, "", LONG, "a a a"]))
    assert stats.shape == (4, quality.N_STATS) and np.isfinite(stats).all()
    assert (stats[0] == stats[1]).all()


def test_a_text_cut_into_slices_scores_as_a_whole(language_model, monkeypatch):
    column = pa.array([("the words of this text are read " * 400)])
    scorer = language_id.Scorer(language_model)
    data, offsets = language_id.text_buffers(column)
    whole = scorer.texts(data, offsets)
    monkeypatch.setattr(language_id, "SLICE_BYTES", 10 * language_id.WINDOW)
    assert np.allclose(scorer.texts(data, offsets), whole)


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    x = np.sort(rng.random(300))
    cx, cy = quality.isotonic(x, (rng.random(300) < x).astype(float), rng.integers(1, 9, 300).astype(float))
    assert (np.diff(cy) > 0).all() and (np.diff(cx) > 0).all()


def test_pipeline(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["language_id", "quality", "near_dedup", "packing"]
    documents = docs = read_table(spark, SF, "documents")
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == documents.columns and docs.count() <= before
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "quality":
            good = [d for d, q in labels.items() if q == 1]
            bad = [d for d, q in labels.items() if q == 0]
            assert np.mean([d in kept for d in good]) >= 0.98 and np.mean([d in kept for d in bad]) <= 0.1
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts))


def test_pipeline_of_odd_documents(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert kept <= {*range(len(ODD_TEXTS)), None, 99} and not kept & {0, 1, 2, 8}  # no text, or none with letters
    empty = odd_docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_pipeline_without_language_labels_keeps_texts_with_letters(spark, odd_docs):
    docs = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.keep_identified(spark, docs, SF).collect()
    assert len(kept) == sum(any(c.isalpha() for c in t or "") for t in ODD_TEXTS) + 3


def one_of_each_group(rows):
    """The ids that stay of (doc_id, text): brute force over five-word groups."""
    return sorted((d for d, _, _, kept in brute(rows, 5) if kept), key=str)


def test_pipeline_keeps_one_of_near_copies(spark, documents, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").limit(150).collect()]
    long = [r for r in rows if len(r[1].split()) >= 100][:40]
    rows += [(10_000 + d, text + " one more") for d, text in long]                   # near copies
    rows += [(20_000 + d, " ".join(text.split()[::-1])) for d, text in long]         # the same words, other groups
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, make_docs(rows), SF).collect()]
    assert sorted(kept, key=str) == one_of_each_group(rows) and not any(10_000 <= d < 20_000 for d in kept)


def test_run_packs_every_token_of_the_kept_documents(spark, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    pieces = {}
    for r in corpus_pipeline.queries()["pipeline"](spark, SF).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert kept and set(pieces) == kept
    for found in pieces.values():
        at = 0
        for start, length, _ in sorted(found):
            assert start == at
            at += length
        assert at == found[0][2]


def test_ids_of_odd_documents_after_each_stage(spark, odd_docs):
    rows = [*enumerate(ODD_TEXTS), (None, "no id at all"), (3, "one"), (99, LONG)]
    first = corpus_pipeline.keep_identified(spark, odd_docs, SF)
    lettered = [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    assert sorted(((r["doc_id"], r["text"]) for r in first.collect()), key=str) == sorted(lettered, key=str)
    model = quality.fit(spark, first, read_table(spark, SF, "labels"), F.lit(True))
    good = [(r["doc_id"], r["text"]) for r in quality.score(first, model, ["doc_id", "text"]).collect() if r["score"] >= 0.3]
    second = corpus_pipeline.keep_good(spark, first, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in second.collect()), key=str) == sorted(good, key=str)
    third = corpus_pipeline.keep_one_of_near_copies(spark, first, SF)
    ids = {r["doc_id"] for r in third.collect()}
    assert ids == set(one_of_each_group(lettered))
    assert {r["doc_id"] for r in corpus_pipeline.pack(spark, third, SF).collect()} == ids


def test_batches_that_go_to_python_are_bounded_by_bytes(spark, tmp_path):
    name, usual = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 48, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 50000) AS text")

    def largest():
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

        return docs.mapInArrow(run, "n bigint").agg({"n": "max"}).first()[0]

    try:
        spark.conf.unset(name)
        assert largest() > 20 << 20
        corpus_pipeline.pack(spark, docs, str(tmp_path))
        assert largest() < 8 << 20
        spark.conf.set(name, "1000")
        small_batches(spark)
        assert spark.conf.get(name) == "1000"
    finally:
        spark.conf.set(name, usual)


def _most_held(operator, docs, monkeypatch) -> int:
    """Most bytes of numpy and Python objects that the task of ``operator`` holds over 3 MB of mostly new words."""
    tasks, rng = [], np.random.default_rng(3)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: tasks.append(run))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    operator(docs)
    words = ["".join(w) for w in rng.choice([*"aeiounrstl"], (100_000, 6))]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [" ".join(rng.choice(words, 600))]}) for i in range(750)]
    batches = pa.Table.from_batches(batches).combine_chunks().to_batches()
    assert len(batches) == 1 and batches[0].nbytes > 3_000_000
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in tasks[0](iter(batches))) >= 750
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_packing_task_holds_little(make_docs, monkeypatch):
    held = _most_held(lambda docs: packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json")),
                      make_docs([]), monkeypatch)
    assert held < 64 << 20


def test_a_signature_task_holds_little(make_docs, monkeypatch):
    held = _most_held(lambda docs: near_dedup.signatures(docs, 5, "doc_id", "text"), make_docs([]), monkeypatch)
    assert held < 32 << 20


def _random_model() -> quality.QualityModel:
    rng = np.random.default_rng(4)
    return quality.QualityModel(
        mean=np.zeros(quality.N_STATS), scale=np.ones(quality.N_STATS), phase=rng.random(quality.FEATURES),
        project=rng.normal(0, 1, (quality.N_STATS, quality.FEATURES)), weights=rng.normal(0, 1, quality.FEATURES + 1),
        curve_x=np.array([0.0, 1.0]), curve_y=np.array([0.0, 1.0]))


def test_a_quality_task_holds_little(make_docs, monkeypatch):
    model = _random_model()
    held = _most_held(lambda docs: quality.score(docs, model, ["doc_id"]), make_docs([]), monkeypatch)
    assert held < 24 << 20


def test_features_of_many_rows_are_not_held_at_once():
    model, stats = _random_model(), np.random.default_rng(5).normal(0, 1, (20_000, quality.N_STATS))
    tracemalloc.start()
    try:
        got = model.ridge(stats, model.weights)
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 16 << 20  # all features take 41 MB
    assert np.allclose(got, model.features(stats) @ model.weights / quality._SCALE)
    assert len(model.ridge(stats[:0], model.weights)) == 0


def test_one_long_text_is_counted_piece_by_piece():
    quality.document_stats(pa.array(["a b"]))
    tracemalloc.start()
    try:
        stats = quality.document_stats(pa.array([LONG * 5]))
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 6 * len(LONG * 5)
    share = {c: sum(LONG.count(x) for x in c) / len(LONG) for c in (" ", "\n", "alphbetgmsd", "42", ",'")}
    got = stats[0, 4:] ** 2
    assert np.allclose(got[[quality._SPACE, quality._NEWLINE, quality._LOWER, quality._DIGIT, quality._POINT]],
                       list(share.values()))


def test_sums_of_quality_partitions_are_exact(spark):
    model, rng = _random_model(), np.random.default_rng(6)
    rows = [(rng.normal(0, 1, quality.N_STATS).tolist(), float(k % 2), k % 3 % 2) for k in range(3000)]
    got = quality._normal_parts(spark.createDataFrame(rows, "stats array<double>, label double, fold int").repartition(5), model)
    z = model.features(np.array([r[0] for r in rows])).astype(np.int64)
    y, fold = (np.array([r[k] for r in rows]).astype(np.int64) for k in (1, 2))
    found = got.collect()
    assert len(found) == 2 * (quality.FEATURES + 1) * (quality.FEATURES + 4) // 2
    gram, right = ([np.einsum("ri,rj->ij", z[fold == f], z[fold == f]) for f in (0, 1)], [y[fold == f] @ z[fold == f] for f in (0, 1)])
    for r in found:
        want = right[r["fold"]][r["i"]] if r["j"] < 0 else gram[r["fold"]][r["i"], r["j"]]
        assert r["high"] * 2 ** 32 + r["low"] == want


def test_quality_query_bounds_its_batches(spark):
    name, usual = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.conf.unset(name)
        assert queries.queries()["op5_fourier_quality"](spark, SF).count() == 1000
        assert int(spark.conf.get(name).lower().rstrip("b")) <= 1 << 20
    finally:
        spark.conf.set(name, usual)
