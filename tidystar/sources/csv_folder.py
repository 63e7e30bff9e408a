"""CSV folder -> raw text tables (inventory S1-S5, S13).

Every top-level ``*.csv`` entry of a folder becomes one raw table named
``raw_<lower-case base name>``. An entry may be a single file (the
reference's case) or a folder of part files.

One record rule for every file size
-----------------------------------
A record ends at LF, CR LF or a bare CR outside a quoted cell; a quote opens a
cell only at its beginning; records of blanks alone are skipped; a record with
more cells than the header is an error, a shorter one is padded with NULL.
Files are read as splittable lines. A line can only begin outside or inside a
quoted cell, so a scan split acts on its lines as a function of that one bit:

1. ``inspect_files``: one pass gives, per split, that function, whether its bytes
   are valid UTF-8, and the header of each file. Composing the functions along a
   file (a window over splits, not rows) tells how each split begins.
2. ``read_raw_csv``: a narrow pass cuts records inside the splits and parses
   them. Only a record that crosses splits inside a quoted cell is put together
   by a shuffle, of its own pieces alone.

No file is ever one task, whatever its quotes. The encoding is chosen per file
(UTF-8 if all its bytes are valid, else Latin-1), and part files are aligned by
the names in their own headers.
"""

from __future__ import annotations

import csv
import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv as pa_csv
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

# --- Fixed values (must equal the reference's for the same results) ---------
# Cells equal to one of these (exactly, no trimming) are missing values: the
# default missing-value list of pandas.read_csv, which the reference relies on.
NULL_MARKERS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                "nan", "null")
PRIMARY_ENCODING = "UTF-8"
FALLBACK_ENCODING = "ISO-8859-1"
RAW_PREFIX = "raw_"
CSV_SUFFIX = ".csv"
# -----------------------------------------------------------------------------

_SCHEME = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(?://[^/]*)?")

#: Largest table of unusual splits (see ``_unusual``) that is broadcast.
BROADCAST_ROWS = 200_000


@dataclass
class RawTable:
    name: str
    path: str
    n_files: int
    df: DataFrame | None = None
    observation: Observation | None = None

    def row_count(self) -> int | None:
        """Rows read, known once an action (the layer write) has run."""
        return self.observation.get.get("rows") if self.observation else None


# --- listing (S1) ----------------------------------------------------------------
def list_csv_entries(spark: SparkSession, folder: str) -> dict[str, tuple[str, int]]:
    """Table name -> (path of its file or folder of part files, number of files).

    One row per table reaches the driver. A missing folder or one without any
    file is an error, and so are two entries whose names differ only by case;
    a folder whose files are not CSV gives no table.
    """
    root = folder.rstrip("/")
    inner = _SCHEME.sub("", root)
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .load(folder).select(F.regexp_replace("path", _SCHEME.pattern, "").alias("path")))
    except AnalysisException as exc:
        raise FileNotFoundError(f"input folder missing: {folder}") from exc
    entry = F.substring_index(F.col("path").substr(len(inner) + 2, 1 << 20), "/", 1)
    rows = files.groupBy(entry.alias("entry")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not rows:
        raise FileNotFoundError(f"input folder is empty: {folder}")
    tables: dict[str, tuple[str, int]] = {}
    seen: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: r.entry):
        if not r.entry.endswith(CSV_SUFFIX):
            continue
        name = RAW_PREFIX + os.path.splitext(r.entry)[0].lower()
        if name in seen:
            raise ValueError(f"entries {seen[name]!r} and {r.entry!r} name the same table {name}")
        seen[name] = r.entry
        tables[name] = (f"{root}/{_literal(r.entry)}", r.n)
    return tables


def _literal(name: str) -> str:
    """A file name with the characters of path patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", name)


# --- cutting records -----------------------------------------------------------------
#: Where something happens in an unquoted cell: a record end, or a cell that opens with a quote.
_NEXT = re.compile(rb',"|\r')


def _after_quote(line: bytes, at: int) -> int:
    """Position after the closing quote of a cell whose text begins at ``at``, or -1."""
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return -1
        if line[at + 1:at + 2] != b'"':
            return at + 1
        at += 2


def scan_line(line: bytes, inside: bool) -> tuple[list[tuple[int, int]], bool]:
    """Record ends of one line (without its LF), as (end, next begin), and whether it ends inside a quoted cell."""
    cuts: list[tuple[int, int]] = []
    at = 0
    opened = inside or line.startswith(b'"')  # ``at`` lies in or opens a quoted cell
    while True:
        if opened:
            at = _after_quote(line, at if inside else at + 1)
            if at < 0:
                return cuts, True
            inside = False
        found = _NEXT.search(line, at)
        if found is None:
            return cuts, False
        if found[0] == b"\r":
            cuts.append((found.start(), found.end()))
            at = found.end()
            opened = line.startswith(b'"', at)
        else:
            at = found.end() - 1
            opened = True


def cut_records(lines: Iterator[bytes], inside: bool):
    """(text, complete, first): records of consecutive lines.

    The first piece is not a whole record if the lines begin inside a cell; the
    last is not complete if they end inside one.
    """
    held: list[bytes] = []
    first = inside
    for line in lines:
        if not inside and b'"' not in line and b"\r" not in line:
            yield line, True, first
            first = False
            continue
        cuts, inside = scan_line(line, inside)
        begin = 0
        for end, after in cuts:
            held.append(line[begin:end])
            yield b"".join(held), True, first
            held, first, begin = [], False, after
        held.append(line[begin:])
        if inside:
            held.append(b"\n")
        else:
            yield b"".join(held), True, first
            held, first = [], False
    if inside:
        yield b"".join(held), False, first


def _blank(record: bytes) -> bool:
    return not record.strip(b" \t")


#: Binary text of one whole record: quotes only around cells or doubled inside them, a CR only at its end.
_REGULAR = r'^(?:"(?:[^"]|"")*"|[^",\r]*)(?:,(?:"(?:[^"]|"")*"|[^",\r]*))*\r?$'


def odd_lines(lines: pa.Array) -> list[int]:
    """Numbers of the lines with a quote that are not a record of regular cells by themselves."""
    odd = pc.and_(pc.match_substring(lines, '"'), pc.invert(pc.match_substring_regex(lines, _REGULAR)))
    return pc.indices_nonzero(odd).to_pylist()


def whole_lines(lines: pa.Array) -> tuple[pa.Array, list[bytes]] | None:
    """(lines that are regular records, the other records) if the lines end outside a cell, else None.

    The lines begin outside a cell. Only from a line that is not regular by itself on are
    lines cut one by one, until its cell is closed. Lines of blanks are left out; a
    line may end with the CR of its line end.
    """
    records, taken, at = [], [], 0
    for i in odd_lines(lines):
        if i < at:  # cut with a line before it
            continue
        held, inside, at = [], False, i
        while at == i or inside:
            if at == len(lines):
                return None
            line = lines[at].as_py()
            cuts, inside = scan_line(line, inside)
            begin = 0
            for end, after in cuts:
                records.append(b"".join([*held, line[begin:end]]))
                held, begin = [], after
            held.append(line[begin:])
            if inside:
                held.append(b"\n")
            taken.append(at)
            at += 1
        records.append(b"".join(held))
    plain = lines
    if taken:
        mask = np.ones(len(lines), bool)
        mask[taken] = False
        plain = lines.filter(pa.array(mask))
    begins = pc.is_in(pc.binary_slice(plain, 0, 1), value_set=pa.array([b"", b" ", b"\t", b"\r"], lines.type))
    if pc.any(begins).as_py():
        keep = [not (b and _blank(x.rstrip(b"\r"))) for b, x in zip(begins.to_pylist(), plain.to_pylist())]
        plain = plain.filter(pa.array(keep, pa.bool_()))
    return plain, [r for r in records if not _blank(r)]


def split_regular(lines: pa.Array, width: int, encoding: str) -> list[pa.Array] | None:
    """Cells by column of regular records, or None if a record has another number of cells."""
    data = b"\n".join(lines.to_pylist())
    if encoding != PRIMARY_ENCODING:
        data = data.decode(encoding).encode()
    cells = [f"c{i}" for i in range(width)]
    try:
        table = pa_csv.read_csv(
            pa.BufferReader(data),
            pa_csv.ReadOptions(use_threads=False, column_names=cells, block_size=max(len(data) + 1, 1 << 16)),
            pa_csv.ParseOptions(newlines_in_values=True),
            pa_csv.ConvertOptions(column_types=dict.fromkeys(cells, pa.string()), null_values=[], check_utf8=False))
    except pa.ArrowInvalid:
        return None
    return [pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], pa.string()) for c in table.columns]


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line bytes) in reading order inside each scan split."""
    return (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("line"),
                    F.is_valid_utf8("value").alias("utf8")))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, pa.RecordBatch]]:
    """Consecutive rows of one (file, block): key, their lines, and the rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        blocks = batch.column("block").to_numpy(zero_copy_only=False)
        turns = np.flatnonzero((blocks[1:] != blocks[:-1]) | (files[1:] != files[:-1])) + 1
        edge = [0, *turns.tolist(), len(blocks)]
        for a, b in zip(edge, edge[1:]):
            part = batch.slice(a, b - a)
            yield (part.column("file")[0].as_py(), int(blocks[a])), part.column("line"), part


# --- pass 1: splits, encodings, headers (S4) --------------------------------------------
def inspect_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per (file, block): how it acts on the open-quote bit, UTF-8 validity, header.

    ``from_out`` / ``from_in``: whether the split ends inside a quoted cell if it
    begins outside / inside one. ``utf8``: whether all bytes of the file are
    valid. ``header``: the file's first record (splits that begin a file only).
    """
    def run(batches):
        now, state, utf8, header, head = None, (False, True), True, None, []
        out: list[tuple] = []
        for key, lines, part in _runs(batches):
            if key != now:
                if now is not None:
                    out.append((*now, *state, utf8, header))
                now, state, utf8, header, head = key, (False, True), True, None, []
            utf8 = utf8 and pc.all(part.column("utf8")).as_py()
            if key[1] == 0 and header is None:
                for line in lines.to_pylist():
                    head.append(line)
                    header = next((text for text, complete, _ in cut_records(iter(head), False)
                                   if complete and not _blank(text)), None)
                    if header is not None:
                        break
            quoted = lines.filter(pc.match_substring(lines, '"'))
            odd, at = iter([*odd_lines(quoted), len(quoted)]), 0
            stop = next(odd)
            while at < len(quoted):
                if state == (False, False):  # regular lines leave it so
                    while stop < at:
                        stop = next(odd)
                    at = stop
                    if at == len(quoted):
                        break
                line = quoted[at].as_py()
                r = scan_line(line, state[0])[1]
                state = (r, r if state[0] == state[1] else scan_line(line, state[1])[1])
                at += 1
        if now is not None:
            out.append((*now, *state, utf8, header))
        columns = list(zip(*out)) or [[]] * 6
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["file", "block", "from_out", "from_in", "utf8", "header"])

    # a line without a quote matters only as a header
    needed = F.when((F.col("block") == 0) | F.contains("line", F.lit(b'"')), F.col("line")).otherwise(F.lit(b""))
    acts = _lines(spark, path).withColumn("line", needed).mapInArrow(
        run, "file string, block bigint, from_out boolean, from_in boolean, utf8 boolean, header binary")
    return acts.withColumn("utf8", F.min("utf8").over(Window.partitionBy("file"))) \
        .withColumn("header", F.first("header", ignorenulls=True).over(Window.partitionBy("file")))


def _unusual(inspected: DataFrame) -> DataFrame:
    """(file, block, inside, latin, header, crossing) of the splits that are not plain.

    A plain split begins and ends outside quoted cells, in a UTF-8 file with the
    usual header. ``inside``: it begins inside a cell. Prefix composition: the
    last split before it that forgets the bit fixes it; every later one that
    flips it counts.
    """
    along = Window.partitionBy("file").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    flip = (F.col("from_out") & ~F.col("from_in")).cast("int")
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").cast("int"))
    rows = inspected.withColumn("flips", F.sum(flip).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("past", F.coalesce(F.lag("flips").over(along), F.lit(0))).withColumn(
        "last", F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("bit"), F.col("flips").alias("flips"))),
                       ignorenulls=True).over(before))
    bit = F.coalesce(F.col("last.bit"), F.lit(0)) + F.col("past") - F.coalesce(F.col("last.flips"), F.lit(0))
    rows = rows.withColumn("inside", bit % 2 == 1)
    ends_inside = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    return rows.select("file", "block", "inside", (~F.col("utf8")).alias("latin"), F.col("header_number").alias("header"),
                       (F.col("inside") | ends_inside).alias("crossing")) \
        .where("inside OR latin OR header > 0 OR crossing")


# --- pass 2: records to rows (S2) --------------------------------------------------------
def header_names(header: bytes, encoding: str) -> list[str]:
    """Column names of a header record; repeated and empty names are made distinct."""
    cells = next(csv.reader([header.decode(encoding).lstrip("﻿")]))
    names: list[str] = []
    for i, cell in enumerate(cells):
        name, n = cell or f"Unnamed: {i}", 0
        while name in names:
            n += 1
            name = f"{cell or f'Unnamed: {i}'}.{n}"
        names.append(name)
    return names


def _parse(records: list[str], columns: list[str], where: str) -> list[list]:
    """Cells by column; a record with more cells than the header is an error."""
    csv.field_size_limit(sys.maxsize)
    width = len(columns)
    rows = []
    for record, cells in zip(records, csv.reader(iter(records))):
        if len(cells) > width:
            raise ValueError(f"{where}: a record has {len(cells)} cells, the header {width}: {record[:200]!r}")
        rows.append(cells if len(cells) == width else cells + [None] * (width - len(cells)))
    return [list(c) for c in zip(*rows)] or [[] for _ in columns]


def _placed(records: list[str], names: list[str], columns: list[str], where: str) -> list[list]:
    """The cells of records under their file's ``names``, as the table's ``columns``."""
    by_name = dict(zip(names, _parse(records, names, where)))
    return [by_name.get(c) or [None] * len(records) for c in columns]


def _records(lines: DataFrame, columns: list[str], headers: list[list[str]]) -> DataFrame:
    """Parsed rows (c0, c1, ...) of the records inside every split, and the pieces of records that cross splits.

    A piece has its file, block and kind: 0 ends a record begun before, 1 begins
    one, 2 lies inside one.
    """
    cells = [f"c{i}" for i in range(len(columns))]

    def run(batches):
        now, inside, skip, encoding, names = None, False, False, PRIMARY_ENCODING, columns
        held, held_first = b"", False  # what is open at the end of a batch

        def out_whole(plain, others):
            """Rows of a run of lines that ends outside a cell, or None."""
            found = split_regular(plain, len(names), encoding) if len(plain) else [pa.array([], pa.string())] * len(names)
            if found is None:
                return None
            if others:
                rest = _parse([r.decode(encoding) for r in others], names, now[0])
                found = [pa.concat_arrays([a, pa.array(b, pa.string())]) for a, b in zip(found, rest)]
            n, by_name = len(found[0]), dict(zip(names, found))
            arrays = [by_name.get(c, pa.nulls(n, pa.string())) for c in columns]
            arrays += [pa.nulls(n, t) for t in (pa.string(), pa.int64(), pa.int32(), pa.binary())]
            return pa.RecordBatch.from_arrays(
                arrays, names=[*cells, "piece_file", "piece_block", "piece_kind", "piece"])

        def out(records, pieces):
            found = _placed([r.decode(encoding) for r in records], names, columns, now[0])
            arrays = [pa.array([*c, *[None] * len(pieces)], pa.string()) for c in found]
            tail = list(zip(*pieces)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
            arrays += [pa.array([*[None] * len(records), *t], kind) for t, kind in zip(tail, types)]
            return pa.RecordBatch.from_arrays(
                arrays, names=[*cells, "piece_file", "piece_block", "piece_kind", "piece"])

        for key, texts, part in _runs(batches):
            if key != now:
                if inside and held:
                    yield out([], [(*now, 2 if held_first else 1, held)])
                now, held = key, b""
                inside = held_first = part.column("inside")[0].as_py()
                encoding = FALLBACK_ENCODING if part.column("latin")[0].as_py() else PRIMARY_ENCODING
                names = headers[part.column("header")[0].as_py()]
                skip = key[1] == 0  # the header record
                if skip:
                    for i, line in enumerate(texts.slice(0, 100).to_pylist()):
                        if not _blank(line.removesuffix(b"\r")):
                            if b'"' not in line and b"\r" not in line[:-1]:
                                texts, skip = texts.slice(i + 1), False
                            break
            if not inside and not skip:
                whole = whole_lines(texts)
                rows = out_whole(*whole) if whole else None
                if rows is not None:
                    yield rows
                    continue
            records, pieces = [], []
            for text, complete, first in cut_records(iter(texts.to_pylist()), inside):
                if first:  # goes on with what the last batch, or the last split, left open
                    text, first = held + text, held_first
                held = b""
                if not complete:
                    held, held_first = text, first
                    break
                if first:
                    pieces.append((*now, 0, text))
                elif skip and not _blank(text):
                    skip = False
                elif not _blank(text):
                    records.append(text)
                held_first = False
            inside = bool(held)
            if records or pieces:
                yield out(records, pieces)
        if inside and held:
            yield out([], [(*now, 2 if held_first else 1, held)])

    return lines.mapInArrow(run, ", ".join(f"{c} string" for c in cells)
                            + ", piece_file string, piece_block bigint, piece_kind int, piece binary")


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """(file, block, text) of the records whose pieces lie in several splits.

    A running count of beginnings along a file names the record.
    """
    along = Window.partitionBy("piece_file").orderBy("piece_block", F.col("piece_kind") != 0)
    rows = pieces.withColumn("record", F.sum((F.col("piece_kind") == 1).cast("int")).over(along))
    parts = F.array_sort(F.collect_list(F.struct("piece_block", F.col("piece_kind").alias("kind"), "piece")))
    joined = rows.groupBy("piece_file", "record").agg(parts.alias("parts"))
    complete = F.element_at("parts", -1)["kind"] == 0
    text = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    return joined.select(
        F.col("piece_file").alias("file"), F.element_at("parts", 1)["piece_block"].alias("block"),
        F.when(complete, text).otherwise(F.raise_error(F.concat(
            F.lit("file ends inside a quoted cell: "), F.col("piece_file"))).cast("binary")).alias("text"))


def null_markers(df: DataFrame, markers=NULL_MARKERS) -> DataFrame:
    """S3: a cell equal to a missing-value marker becomes NULL; spaces stay text."""
    def quoted(c):
        return F.col("`" + c.replace("`", "``") + "`")

    return df.select(*[F.when(~quoted(c).isin(*markers), quoted(c)).alias(c) for c in df.columns])


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of files or folders of part files, every column text.

    The inspection pass runs here; the rows are lazy.
    """
    inspected = inspect_files(spark, path).cache()
    found = inspected.where("block = 0").groupBy("header", "utf8").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), "header").collect()  # the table's columns come from them
    if not found or any(h.header is None for h in found):
        raise ValueError(f"a file without a header record: {path}")
    headers = [header_names(h.header, PRIMARY_ENCODING if h.utf8 else FALLBACK_ENCODING) for h in found]
    columns = list(dict.fromkeys(c for own in headers for c in own))
    numbers = spark.createDataFrame([(bytes(h.header), h.utf8, i) for i, h in enumerate(found)],
                                    "header binary, utf8 boolean, header_number int")
    # as many rows as the table has different headers, all of which are on the driver
    unusual = _unusual(inspected.join(F.broadcast(numbers), ["header", "utf8"]))
    some = unusual.limit(BROADCAST_ROWS + 1).collect()
    lines = _lines(spark, path).select("file", "block", "line")
    if len(some) <= BROADCAST_ROWS:  # a measured bound; a broadcast join keeps the lines' order
        crossing = any(r.crossing for r in some)
        unusual = spark.createDataFrame(some, unusual.schema)
        lines = lines.join(F.broadcast(unusual), ["file", "block"], "left")
        inspected.unpersist()
    else:
        crossing = not unusual.where("crossing").isEmpty()
        lines = lines.withColumn("at", F.monotonically_increasing_id()).join(unusual, ["file", "block"], "left") \
            .repartition("file", "block").sortWithinPartitions("file", "block", "at")
    plain = [F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("latin", F.lit(False)).alias("latin"),
             F.coalesce("header", F.lit(0)).alias("header")]
    rows = _records(lines.select("file", "block", "line", *plain), columns, headers)
    cells = [f"c{i}" for i in range(len(columns))]
    whole = rows.select(cells)
    if crossing:
        pieces = rows.where("piece IS NOT NULL").select("piece_file", "piece_block", "piece_kind", "piece")
        joined = _joined_pieces(pieces).join(unusual, ["file", "block"], "left")
        whole = rows.where("piece IS NULL").select(cells) \
            .union(_parsed_texts(joined.select("file", "text", *plain), columns, headers))
    return null_markers(whole.toDF(*columns))


def _parsed_texts(texts: DataFrame, columns: list[str], headers: list[list[str]]) -> DataFrame:
    """Rows (c0, c1, ...) of single record texts."""
    cells = [f"c{i}" for i in range(len(columns))]

    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                encoding = FALLBACK_ENCODING if row["latin"] else PRIMARY_ENCODING
                found = _placed([row["text"].decode(encoding)], headers[row["header"]], columns, row["file"])
                rows.append([c[0] for c in found])
            by_column = list(zip(*rows)) or [[]] * len(cells)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in by_column], names=cells)

    return texts.mapInArrow(run, ", ".join(f"{c} string" for c in cells))


def raw_table(spark: SparkSession, name: str, path: str, n_files: int) -> RawTable:
    """One entry as a lazy raw text table whose rows are counted while they are written."""
    obs = Observation(name)
    df = read_raw_csv(spark, path).observe(obs, F.count(F.lit(1)).alias("rows"))
    return RawTable(name, path, n_files, df, obs)


def load_raw_folder(spark: SparkSession, folder: str) -> dict[str, RawTable]:
    """S1-S4 + S13: every CSV entry of ``folder`` as a lazy raw text table with its counts."""
    return {name: raw_table(spark, name, path, n)
            for name, (path, n) in list_csv_entries(spark, folder).items()}


def write_raw_csv(df: DataFrame, path: str, encoding: str = PRIMARY_ENCODING) -> None:
    """Write a text table as a CSV folder that ``load_raw_folder`` reads back as is."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
       .option("escape", '"').option("emptyValue", '""').option("encoding", encoding)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))
