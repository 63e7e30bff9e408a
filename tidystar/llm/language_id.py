"""Language identification with a small byte convolutional network.

Training, on the driver in numpy, uses a bounded sample of labelled rows:
``DOCS_PER_LANG`` documents of each label, chosen by a hash of id and text, with
an excerpt of ``EXCERPT`` characters each; with so many labels that this exceeds
``SAMPLE_DOCS`` documents, fewer of each, but at least one. Every label is learned, however
many there are, with the same share of the training steps.
The network embeds bytes, applies filters of widths 2, 3 and 4, takes the
maximum over a window and a softmax over the labels.

Prediction covers whole texts: the bytes are cut into fixed windows of
``WINDOW`` bytes, windows go through the network in batches, and a text's
probabilities are the means over its windows, weighted by their letters. Because
the inputs are bytes, the filters' products are tabulated once per task for
single symbols and pairs of symbols; a window then costs table look-ups.

Defined results: NULL text or text without a letter gives ``und`` and score 0.0;
so does every text if there are no labelled rows. Only the text is an input of a
prediction. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidystar.llm.common import SLICE_BYTES, annotate, text_buffers

#: Bounds of the training sample.
DOCS_PER_LANG = 400
SAMPLE_DOCS = 256 * DOCS_PER_LANG
EXCERPT = 1024
#: Bytes of a window.
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
UNDETERMINED = "und"
_REACH = max(WIDTHS) - 1
#: Windows looked up together.
_BATCH = 512


def _symbols() -> np.ndarray:
    """Byte to symbol: 0 padding, 1 blank or punctuation, 2 digit, 3.. letters and high bytes."""
    out = np.ones(256, np.uint8)
    out[ord("0"):ord("9") + 1] = 2
    out[ord("a"):ord("z") + 1] = out[ord("A"):ord("Z") + 1] = np.arange(3, 29)
    out[128:] = np.arange(29, 157)
    return out


SYMBOLS = _symbols()
N_SYMBOLS = 157


@dataclass
class LanguageModel:
    labels: list[str]
    embed: np.ndarray = None       # (symbols, EMBED)
    filters: list = None           # per width (width, EMBED, FILTERS)
    bias: np.ndarray = None        # (widths * FILTERS,)
    dense: np.ndarray = None       # (widths * FILTERS, labels)
    offset: np.ndarray = None      # (labels,)


def _fold(data: np.ndarray) -> np.ndarray:
    """Symbols of UTF-8 bytes; capitals U+00C0..U+00DE fold to small letters."""
    out = SYMBOLS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[lead + 1]
    up = (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
    out[lead[up] + 1] += 32
    return out


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, WINDOW + _REACH) symbols, zero padded, and each window's text."""
    symbols = np.concatenate([_fold(data), np.zeros(1, np.uint8)])
    n_win = -(-np.diff(offsets) // WINDOW)
    doc = np.repeat(np.arange(len(n_win)), n_win)
    index = np.arange(len(doc)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    at = (offsets[doc] + index * WINDOW)[:, None] + np.arange(WINDOW)
    out = np.zeros((len(doc), WINDOW + _REACH), np.uint8)
    out[:, :WINDOW] = np.where(at < offsets[doc + 1][:, None], symbols[np.minimum(at, len(data))], 0)
    return out, doc


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


class Scorer:
    """Window probabilities of a model through tables of symbol and pair products."""

    def __init__(self, model: LanguageModel):
        single = [np.stack([model.embed @ k[j] for j in range(len(k))]) for k in model.filters]
        pair = [(s[0][:, None] + s[1][None]).reshape(N_SYMBOLS ** 2, FILTERS) for s in single]
        self.model = model
        self.head = np.ascontiguousarray(np.concatenate(pair, axis=1) + model.bias, np.float32)
        self.third = np.ascontiguousarray(single[1][2], np.float32)
        self.tail = np.ascontiguousarray(
            (single[2][2][:, None] + single[2][3][None]).reshape(N_SYMBOLS ** 2, FILTERS), np.float32)

    def features(self, x: np.ndarray) -> np.ndarray:
        best = np.zeros((len(x), len(WIDTHS) * FILTERS), np.float32)
        x = np.ascontiguousarray(x.T, dtype=np.intp)
        pairs = x[:-1] * N_SYMBOLS + x[1:]
        now = np.empty_like(best)
        for p in range(WINDOW):
            np.take(self.head, pairs[p], axis=0, out=now, mode="clip")
            now[:, FILTERS:2 * FILTERS] += self.third[x[p + 2]]
            now[:, 2 * FILTERS:] += self.tail[pairs[p + 2]]
            np.maximum(best, now, out=best)
        return best

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        found = [self.features(x[i:i + _BATCH]) for i in range(0, len(x), _BATCH)]
        return _softmax(np.concatenate(found) @ self.model.dense + self.model.offset)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts, labels) mean probabilities; zeros for a text without letters."""
        if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:  # one very long text: so many windows at a time
            parts = [self._sums(data[a:a + SLICE_BYTES], np.array([0, len(data[a:a + SLICE_BYTES])]))
                     for a in range(0, len(data), SLICE_BYTES)]
            sums, weight = sum(p[0] for p in parts), sum(p[1] for p in parts)
        else:
            sums, weight = self._sums(data, offsets)
        return sums / np.maximum(weight, 1)[:, None]

    def _sums(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: probabilities of its windows weighted by their letters, and the letters."""
        sums, total = np.zeros((len(offsets) - 1, len(self.model.labels))), np.zeros(len(offsets) - 1)
        x, doc = windows(data, offsets)
        if len(x):
            weight = (x > 2).sum(axis=1).astype(np.float64)
            firsts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            total[doc[firsts]] = np.add.reduceat(weight, firsts)
            sums[doc[firsts]] = np.add.reduceat(self.probabilities(x) * weight[:, None], firsts)
        return sums, total


def _train(x: np.ndarray, y: np.ndarray, labels: list[str], epochs: int, seed: int) -> LanguageModel:
    """Adam on the cross entropy of windows ``x`` (n, WINDOW) of labels ``y``."""
    rng = np.random.default_rng(seed)
    params = {"embed": rng.normal(0, 0.5, (N_SYMBOLS, EMBED)), "bias": np.zeros(len(WIDTHS) * FILTERS),
              "dense": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels))), "offset": np.zeros(len(labels))}
    for w in WIDTHS:
        params[f"k{w}"] = rng.normal(0, (w * EMBED) ** -0.5, (w, EMBED, FILTERS))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    batch = 64
    steps = max(epochs * len(x) // batch, 1)
    # windows are drawn by label in equal shares
    by_label = np.argsort(y, kind="stable")
    _, begins, counts = np.unique(y[by_label], return_index=True, return_counts=True)
    while step < steps:
        label = rng.integers(0, len(begins), batch)
        take = by_label[begins[label] + rng.integers(0, counts[label])]
        xb, yb = x[take], y[take]
        # some windows end early, as the last one of a text does
        short = np.where(rng.random(batch) < 0.3, rng.integers(8, WINDOW, batch), WINDOW)
        xb = np.where(np.arange(WINDOW) < short[:, None], xb, 0)
        xb = np.concatenate([xb, np.zeros((batch, _REACH), xb.dtype)], axis=1)
        embed = params["embed"] * (np.arange(N_SYMBOLS) > 0)[:, None]
        e = embed[xb]
        maxima, places = [], []
        for i, w in enumerate(WIDTHS):
            patch = np.concatenate([e[:, j:j + WINDOW] for j in range(w)], axis=2)
            conv = patch @ params[f"k{w}"].reshape(w * EMBED, FILTERS)
            places.append(conv.argmax(axis=1))
            maxima.append(np.take_along_axis(conv, places[-1][:, None], axis=1)[:, 0])
        z = np.concatenate(maxima, axis=1) + params["bias"]
        h = np.maximum(z, 0)
        prob = _softmax(h @ params["dense"] + params["offset"])
        prob[np.arange(batch), yb] -= 1
        prob /= batch
        grad = {k: np.zeros_like(v) for k, v in params.items()}
        grad["dense"], grad["offset"] = h.T @ prob, prob.sum(axis=0)
        dz = (prob @ params["dense"].T) * (z > 0)
        grad["bias"] = dz.sum(axis=0)
        for i, w in enumerate(WIDTHS):
            g = dz[:, i * FILTERS:(i + 1) * FILTERS]
            where = places[i][:, :, None] + np.arange(w)
            at = xb[np.arange(batch)[:, None, None], where]
            grad[f"k{w}"] = np.einsum("bf,bfjd->jdf", g, embed[at])
            np.add.at(grad["embed"], at, g[:, :, None, None] * params[f"k{w}"].transpose(2, 0, 1)[None])
        grad["embed"][0] = 0
        step += 1
        for k, v in params.items():
            m, s = moments[k]
            m += 0.1 * (grad[k] - m)
            s += 0.001 * (grad[k] ** 2 - s)
            rate = 5e-3 * min(1.0, 2 * (1 - step / steps) + 0.05)
            v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return LanguageModel(labels, params["embed"] * (np.arange(N_SYMBOLS) > 0)[:, None],
                         [params[f"k{w}"] for w in WIDTHS], params["bias"], params["dense"], params["offset"])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
        docs_per_lang: int = DOCS_PER_LANG, epochs: int = 6, seed: int = 7) -> LanguageModel:
    """Learn from a bounded sample of the rows of ``docs`` where ``learn`` holds."""
    rows = docs.where(learn).where((F.col(lang_col) != UNDETERMINED) & F.col(text_col).rlike(r"\p{L}")) \
        .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # the model's outputs
    labels = sorted(counts)
    if not labels:
        return LanguageModel([])
    docs_per_lang = max(1, min(docs_per_lang, SAMPLE_DOCS // len(labels)))
    key = F.xxhash64("id", "text")
    # of a frequent label about four times the wanted rows pass a threshold on the key, so
    # that few rows of it meet in one task; the smallest keys among them are taken
    shares = docs.sparkSession.createDataFrame(
        [(label, int(min(1.0, 4 * docs_per_lang / n) * (2 ** 31 - 1))) for label, n in counts.items()],
        "lang string, share bigint")
    rows = rows.join(F.broadcast(shares), "lang").where(F.pmod(key, F.lit(2 ** 31 - 1)) < F.col("share"))
    begin = F.pmod(key, F.greatest(F.length("text") - EXCERPT, F.lit(1)))
    sample = rows.select(
        "lang", key.alias("key"), F.substring("text", begin.cast("int") + 1, F.lit(EXCERPT)).alias("excerpt"))
    sample = sample.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("key", "excerpt"))) \
        .where(F.col("n") <= docs_per_lang).orderBy("lang", "key", "excerpt").collect()
    data, offsets = text_buffers(pa.array([r["excerpt"] for r in sample], pa.string()))
    x, doc = windows(data, offsets)
    number = {label: i for i, label in enumerate(labels)}
    y = np.array([number[r["lang"]] for r in sample])[doc]
    del sample, data
    lettered = (x > 2).any(axis=1)
    return _train(x[lettered][:, :WINDOW], y[lettered], labels, epochs, seed)


def predict(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text",
            lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """The ``keep`` columns with the predicted language and its mean probability."""
    def make():
        scorer = Scorer(model) if model.labels else None

        def run(column):
            data, offsets = text_buffers(column)
            lettered = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False) \
                .to_numpy(zero_copy_only=False)
            if scorer is None:
                lettered = np.zeros(len(column), bool)
                probs = np.zeros((len(column), 1))
            else:
                probs = scorer.texts(data, offsets)
            best = probs.argmax(axis=1)
            names = [model.labels[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
            scores = np.where(lettered, np.clip(probs.max(axis=1), 0, 1), 0.0)
            return [pa.array(names, pa.string()), pa.array(scores)]

        return run

    return annotate(docs, text_col, keep, f"{lang_out} string, {score_out} double", make)
