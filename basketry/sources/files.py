"""Landed files: report payloads, sales CSV, one CSV per store, partner list."""

import binascii
import codecs
import contextlib
import csv
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.clean import zero_fill
from basketry.operators.staging import write_stage
from basketry.operators.validate import require_columns
from basketry.schemas import all_strings

STORE_FILE = r"/(?:store_file=)?([^/=]+)\.csv(?:/part-[^/]+)?$"

# The letters of base64, and the white space that may stand between them.
BASE64 = (string.ascii_letters + string.digits + "+/").encode()
WHITE = b" \t\n\x0b\x0c\r"
# Bytes of a body that are decoded at a time, and records that leave a task at a time; first bytes of a file that are
# looked at, and the length of lines that base64 is cut into, about and at most on average.
PIECE = 1 << 20
HEAD = 1 << 16
LINE = 2000
RECORDS_AT_ONCE = 5000

# One cell: text in quotes, which may hold commas, doubled quotes and line breaks, or plain text, or nothing.
CELL = r'(?:"(?:[^"]++|"")*+"?[^,\r\n]*+|[^,"\r\n][^,\r\n]*+)?+'
RECORD = rf"{CELL}(?:,{CELL})*+"
_RECORD, _CELL, _QUOTED = re.compile(RECORD), re.compile(f",({CELL})"), re.compile('^"((?:[^"]++|"")*+)"?')


def read_sales_csv(spark: SparkSession, path, columns=None, multi_line: bool = True) -> DataFrame:
    """Sales CSV with every column as text. Column names are taken from the header.

    Line breaks inside quotes belong to their cell, so a file is read by one task. Files that are known to have
    none are split over tasks with ``multi_line=False``.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').option("multiLine", multi_line)
    if columns is not None:
        reader = reader.schema(all_strings(columns)).option("enforceSchema", False)
    return reader.csv(path)


def csv_cells(record: Column) -> Column:
    """The cells of one record, however many; a cell without text and quotes is null."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({CELL})"), F.lit(1))
    unquoted = lambda c: F.replace(F.regexp_replace(c, '^"((?:[^"]++|"")*+)"?', "$1"), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(c.startswith('"'), unquoted(c)).when(c != "", c))


class StrictBase64:
    """Whether text that comes in pieces is base64 once white space is gone: whole groups of four, padding at the end only."""

    def __init__(self):
        self.size = self.padding = 0
        self.valid = True

    def feed(self, piece: bytes) -> bool:
        packed = piece.translate(None, WHITE)
        letters = packed.rstrip(b"=")
        self.valid &= not (self.padding and letters or letters.translate(None, BASE64))
        self.size, self.padding = self.size + len(packed), self.padding + len(packed) - len(letters)
        return self.valid

    def whole(self) -> bool:
        return self.valid and self.size % 4 == 0 and self.padding <= 2


class CsvRecords:
    """Records of a CSV body, plain or base64, that comes in pieces. Blank lines are left out. Only the record that may go
    on is held."""

    def __init__(self, packed: bool):
        self.packed, self.rest, self.left, self.least, self.begun = packed, b"", "", 0, False
        self.decoder = codecs.getincrementaldecoder("utf-8")("strict" if packed else "replace")

    def feed(self, piece: bytes, last: bool = False) -> list[str]:
        if self.packed:
            packed = self.rest + piece.translate(None, WHITE)
            whole = len(packed) // 4 * 4
            piece, self.rest = binascii.a2b_base64(packed[:whole]), packed[whole:]
        text = self.decoder.decode(piece, final=last)
        if text and not self.begun:
            text, self.begun = text.removeprefix("\ufeff"), True
        self.left += text
        if not last and len(self.left) < self.least:
            return []
        records, end = [], 0
        for found in _RECORD.finditer(self.left):
            if found.end() == len(self.left) and not last:
                break
            end = found.end()
            if found.group().strip(" "):
                records.append(found.group())
        self.left = self.left[end:]
        self.least = 2 * len(self.left)  # so that a long record isn't searched again for each piece
        return records


def header_cells(record: str) -> list:
    """The cells of a record as ``csv_cells`` gives them."""
    cells = [found.group(1) for found in _CELL.finditer("," + record)]
    return [_QUOTED.sub(r"\1", c).replace('""', '"') if c.startswith('"') else c or None for c in cells]


class _Download:
    """Batches of (source_file, at, record) of one download: its records but for the header, and the places of the columns
    in the header, from 1; 0 for those it lacks."""

    def __init__(self, name: str, packed: bool, columns: list):
        self.name, self.records, self.columns, self.at = name, CsvRecords(packed), columns, None

    def feed(self, piece: bytes, last: bool = False) -> Iterator[pa.RecordBatch]:
        records = self.records.feed(piece, last)
        if records and self.at is None:
            names = header_cells(records.pop(0))
            self.at = [names.index(c) + 1 if c in names else 0 for c in self.columns]
        for k in range(0, len(records), RECORDS_AT_ONCE):
            some = records[k:k + RECORDS_AT_ONCE]
            each = pa.array(np.zeros(len(some), np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.name]).take(each), pa.array([self.at], pa.list_(pa.int32())).take(each), pa.array(some, pa.string())],
                names=["source_file", "at", "record"])


def _runs(batches) -> Iterator[tuple[int, list[bytes]]]:
    """(file, lines) of batches (file, value), whose files follow each other."""
    for batch in batches:
        files = batch.column("file").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield int(files[a]), batch.column("value").slice(a, b - a).to_pylist()


def _bodies(batches, mark: bytes, ended: bool, begin, end) -> Iterator:
    """Each file's text in pieces, put together again from its lines, to ``begin(file).feed``; ``end`` gets what begin gave."""
    now = of = None
    for file, lines in _runs(batches):
        if file != now:
            if of is not None:
                yield from end(of, mark if ended else b"")
            now, of, before = file, begin(file), b""
        text = before + mark.join(lines)
        before = mark
        for k in range(0, len(text), PIECE):
            yield from of.feed(text[k:k + PIECE]) or ()
    if of is not None:
        yield from end(of, mark if ended else b"")


def _listed(texts: DataFrame):
    """(path, size, compressed, first bytes, last byte) of the files of a DataFrame that are not empty."""
    jvm, conf = texts.sparkSession._jvm, texts.sparkSession._jsparkSession.sessionState().newHadoopConf()
    codecs_ = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for uri in sorted(texts.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        files = path.getFileSystem(conf)
        size = files.getFileStatus(path).getLen()
        if size:
            stream = files.open(path)
            try:
                head = bytes(stream.readNBytes(HEAD))
                stream.seek(size - 1)
                yield path.toString(), size, codecs_.getCodec(path) is not None, head, bytes([stream.read()])
            finally:
                stream.close()


def _line_mark(head: bytes, last: bytes) -> bytes:
    """What cuts a body into short lines: the line break, or for base64 in one line a letter that is rare but not too rare
    in its first bytes. Lines are put together again, so any letter gives the same text."""
    if b"\n" in head or head.translate(None, BASE64 + WHITE + b"="):
        return b"\n"
    uses = {bytes([c]): head.count(c) for c in BASE64 if bytes([c]) != last}
    often = [c for c in uses if uses[c] * LINE >= len(head)]
    return min(often, key=uses.get) if often else max(uses, key=uses.get)


@contextlib.contextmanager
def _whole_files(spark: SparkSession, largest: int):
    """While it lasts, a scan gives each file to one task. Yields whether that could be set."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(max(largest, 1 << 24)), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield all(spark.conf.get(k, None) == v for k, v in wanted.items())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def decode_report_payloads(spark: SparkSession, path, columns) -> DataFrame:
    """Downloads that are CSV or base64 of CSV, as rows of text columns.

    Each download is streamed by one task in short lines, so none is held as a whole; whether a body is base64 shows at
    its end only, so those that begin like it are read once more before. Compressed downloads are read as one value.
    The columns of each download are found by its own header, in any order and of any number; columns it lacks are null.
    Line breaks inside quotes are kept. The rows are written to the shared folder.
    """
    columns = list(columns)
    fields = "source_file string, at array<int>, record string"
    groups, compressed, largest = {}, [], 0
    for file, size, coded, head, last in _listed(spark.read.text(path, wholetext=True)):
        if coded:
            compressed.append(_literal_path(file))
        else:
            mark, largest = _line_mark(head, last), max(largest, size)
            likely = not head.translate(None, BASE64 + WHITE + b"=")
            groups.setdefault((mark, mark == last, likely), []).append(_literal_path(file))
    records = spark.createDataFrame([], fields)
    with _whole_files(spark, largest) as in_order:
        for (mark, ended, likely), files in groups.items():
            lines = spark.read.option("lineSep", mark.decode()).option("recursiveFileLookup", True).text(files).select(
                F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("value").cast("binary").alias("value"),
                F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"))
            if not in_order:
                lines = lines.withColumn("place", F.monotonically_increasing_id()).repartition("file").sortWithinPartitions("file", "start", "place")
            names = dict(map(tuple, _file_names(lines.sparkSession, files).collect()))
            packed = set()
            if likely:
                packed = {r["file"] for r in lines.select("file", "value").mapInArrow(_checked(mark, ended), "file long, packed boolean").collect() if r["packed"]}
            records = records.unionByName(lines.select("file", "value").mapInArrow(_cut(mark, ended, names, packed, columns), fields))
        if compressed:
            bodies = spark.read.text(compressed, wholetext=True).select(
                F.col("_metadata.file_name").alias("source_file"), F.col("value").cast("binary").alias("value"))
            records = records.unionByName(bodies.mapInArrow(_cut_whole(columns), fields))
        parsed = records.withColumn("cells", csv_cells(F.col("record"))).select(
            "source_file", *[F.get("cells", F.get("at", F.lit(i)) - 1).alias(c) for i, c in enumerate(columns)])
        return write_stage(parsed, "downloads")


def _file_names(spark: SparkSession, files: list) -> DataFrame:
    """(file, name) of files; none is opened."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(files).select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_name").alias("name"))


def _checked(mark: bytes, ended: bool):
    def check(batches):
        found = []
        open_ = {}

        def begin(file):
            open_["file"] = file
            return _Fed(StrictBase64())

        def end(of, tail):
            of.feed(tail)
            found.append((open_["file"], of.by.whole()))
            return ()

        for _ in _bodies(batches, mark, ended, begin, end):
            pass
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.int64()), pa.array([w for _, w in found], pa.bool_())], names=["file", "packed"])

    return check


class _Fed:
    """Feeds and gives nothing."""

    def __init__(self, by):
        self.by = by

    def feed(self, piece: bytes) -> tuple:
        self.by.feed(piece)
        return ()


def _cut(mark: bytes, ended: bool, names: dict, packed: set, columns: list):
    begin = lambda file: _Download(names[file], file in packed, columns)
    end = lambda of, tail: of.feed(tail, last=True)
    return lambda batches: _bodies(batches, mark, ended, begin, end)


def _cut_whole(columns: list):
    def cut(batches):
        for batch in batches:
            for name, body in zip(batch.column("source_file").to_pylist(), batch.column("value")):
                body = body.as_buffer().to_pybytes() if body.is_valid else b""
                check = StrictBase64()
                check.feed(body)
                of = _Download(name, check.whole(), columns)
                for k in range(0, len(body), PIECE):
                    yield from of.feed(body[k:k + PIECE])
                yield from of.feed(b"", last=True)

    return cut


def store_file_key(store) -> Column:
    """Store name as it appears in a file name."""
    store = F.col(store) if isinstance(store, str) else store
    return F.translate(store, "/", "_")


def _headers(files: DataFrame):
    """(path, column names) of each CSV file with a first record, of which only that record is read."""
    jvm, conf = files.sparkSession._jvm, files.sparkSession._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    for uri in sorted(files.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream, codec = path.getFileSystem(conf).open(path), codecs.getCodec(path)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            record = line = lines.readLine()
            while line is not None and (not record.strip("\ufeff \t") or record.count('"') % 2):
                line = lines.readLine()
                if line is not None:
                    record = f"{record}\n{line}" if record.count('"') % 2 else line
        finally:
            lines.close()
        if record and record.strip("\ufeff \t"):
            yield path.toString(), next(csv.reader([record.lstrip("\ufeff")], strict=False))


def _literal_path(path: str) -> str:
    return "".join(f"\\{c}" if c in "\\*?[]{}" else c for c in path)


def read_store_csv_dir(spark: SparkSession, path: str, columns, numeric_columns=(), stores: DataFrame = None,
                       multi_line: bool = True) -> DataFrame:
    """All per-store CSV files of a folder, with storeName taken from the file name.

    A store may also be a folder ``<store>.csv`` (or ``store_file=<store>.csv``) of part files.
    Columns are found by the header of each file, so files may hold others and in any order; columns that a file
    lacks are null. Files whose headers have the columns at the same places are one scan. Line breaks inside quotes
    belong to their cell, so a file is streamed by one task; files that are known to have none are split over tasks
    with ``multi_line=False``. With ``stores`` (storeName), the file key is turned back into the real store name and
    files of unknown stores are left out; a store without a file has no rows.
    """
    columns = [c for c in columns if c != "storeName"]
    groups = {}
    for file, names in _headers(spark.read.option("recursiveFileLookup", True).text(path)):
        places = tuple(names.index(c) if c in names else None for c in columns)
        groups.setdefault((places, len(names)), []).append(_literal_path(file))
    file_path = F.expr("url_decode(replace(_metadata.file_path, '+', '%2B'))")
    typed = spark.createDataFrame([], all_strings(["store_key", *columns]))
    for (places, width), files in groups.items():
        rows = spark.read.options(header=True, escape='"', multiLine=multi_line, recursiveFileLookup=True, maxColumns=max(20480, 2 * width),
                                  columnNameOfCorruptRecord="odd").schema(all_strings([*[f"c{i}" for i in range(width)], "odd"])).csv(files)
        # A line of blanks alone is no row.
        rows = rows.where((F.trim(F.coalesce("c0", F.lit(""))) != "") | F.col("odd").isNull() | F.col("odd").rlike(r"\S"))
        typed = typed.unionByName(rows.select(
            F.regexp_extract(file_path, STORE_FILE, 1).alias("store_key"),
            *[(F.lit(None).cast("string") if i is None else F.col(f"c{i}")).alias(c) for c, i in zip(columns, places)]))
    typed = typed.select("store_key", *[zero_fill(c).alias(c) if c in numeric_columns else F.col(c) for c in columns])
    if stores is None:
        return typed.withColumnRenamed("store_key", "storeName")
    names = stores.select("storeName").distinct().withColumn("store_key", store_file_key("storeName"))
    return typed.join(names, "store_key").select("storeName", *columns)


def read_partners(spark: SparkSession, path: str) -> DataFrame:
    """Partner list; storeName and wa_number must exist, rows without a number are dropped."""
    partners = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(partners, ["storeName", "wa_number"])
    return partners.dropna(subset=["wa_number"])
