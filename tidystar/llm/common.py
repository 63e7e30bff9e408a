"""Helpers shared by the training-data operators.

Texts are handled inside tasks as Arrow buffers: one ``uint8`` array with the
bytes of all texts of a batch, and the offsets where each text begins. The
helpers cut batches so that no more than a fixed number of text bytes is
unpacked at a time (a single longer text is a batch of its own).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidystar.session import scratch_path

#: Text bytes that a task unpacks into numpy arrays at a time.
SLICE_BYTES = 1 << 20
#: Bytes of a batch that a task hands to Python; more would lie in both processes at once.
BATCH_BYTES = SLICE_BYTES

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files hold ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers of this machine import the package from where it lies.

    On a cluster the package is installed on the executors (or given with
    ``--py-files``); then this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound the batches that go to Python by their bytes, whatever the length of the texts.

    A lower number of bytes set in the session stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower().rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def cut_lineage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys with more than this part (1 in so many) of all rows are joined by broadcast.
HOT = 1000


def join_hot(rows: DataFrame, by_key: DataFrame, key: str, n_rows: str, how_many: int = HOT) -> DataFrame:
    """Inner join on ``key`` that no hot key makes uneven.

    ``by_key`` has one row per key, with the number of its rows in ``n_rows``. Keys with more than
    one in ``how_many`` of all those rows are fewer than ``how_many`` and are broadcast;
    the rest is shuffled, no key with more than that share.
    """
    total = by_key.agg(F.sum(n_rows)).first()[0] or 0
    is_hot = F.col(n_rows) * how_many > F.lit(total)
    hot = F.broadcast(by_key.where(is_hot))
    rest = rows.join(hot.select(key), key, "left_anti").join(by_key.where(~is_hot), key)
    return rows.join(hot, key).select(rest.columns).union(rest)


def hash_remainder(id_col, divisor: int):
    """crc32 of the id as text, modulo ``divisor`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (length n + 1) of a string column; a NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str | int,
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``max_bytes`` in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + max_bytes, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last


def is_blank(data: np.ndarray) -> np.ndarray:
    """Bytes that are space or TAB..CR."""
    return (data == 0x20) | ((data >= 9) & (data <= 13))


def blank_cuts(data: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end before a blank; a longer word stays whole."""
    at, n = 0, len(data)
    while at < n:
        end = at + size
        while end < n:
            blank = np.flatnonzero(is_blank(data[end:end + size]))
            if len(blank):
                end += int(blank[0])
                break
            end += size
        end = min(end, n)
        yield at, end
        at = end


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), vectorised."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeded_words(seed: int, n: int, odd: bool = False) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words, the same in every process."""
    x = np.random.Generator(np.random.PCG64(seed)).integers(0, 2 ** 64, n, dtype=np.uint64)
    return x | np.uint64(1) if odd else x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``starts[i] .. starts[i] + lengths[i]``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def annotate(df: DataFrame, text_col: str, keep: list[str], fields: str, make,
             max_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``keep`` columns of ``df`` and new columns computed from whole texts.

    ``make()`` runs once per task and returns a function from a text column to
    the list of new Arrow arrays; ``fields`` names and types them. It gets texts of
    about ``max_bytes`` at a time. New names must not clash with ``keep``. One narrow pass.
    """
    types = T.StructType.fromDDL(fields)
    clash = {f.name.lower() for f in types} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    positions = {c: i for i, c in enumerate(keep)}
    rows = df.select(*[F.col(f"`{c}`") for c in keep], *([] if text_col in positions else [F.col(f"`{text_col}`")]))
    at = positions.get(text_col, len(keep))
    names = [*keep, *(f.name for f in types)]

    def run(batches):
        fn = make()
        for batch in slices(batches, at, max_bytes):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], *fn(batch.column(at))], names=names)

    return rows.mapInArrow(run, T.StructType([df.schema[c] for c in keep] + list(types)))
