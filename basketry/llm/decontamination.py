"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are brought to one form: lower-case words with a space before and after each. The windows of the benchmark
items are the patterns. A table tells for each block of bytes how far the search may jump; where it says zero,
the hash of the text's suffix chooses the patterns that are compared byte by byte. Many texts are searched side
by side, each with its own place, so that every step is a vector operation.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from basketry.llm.common import arrow_schema, cover, renamed, spans_of, stage, tidy

WINDOW = 10
PATTERN_BYTES_PER_BLOCK = 64 << 20
BYTES_PER_PATTERN = 256  # besides its own bytes: Python objects, bucket and table entries
SEARCH_BYTES = 1 << 20
LANE = 2048
BLOCK = 6
TABLE_BITS = 20

_TABLE = bytes(
    c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUNS = StructType().add("starts", ArrayType(IntegerType())).add("lengths", ArrayType(IntegerType()))
_FOUND = StructType([*StructType().add("n_words", "long"), *_RUNS.fields]).add("patterns", ArrayType(LongType()))


def plain_words(text) -> list:
    """Lower-case words of a text as UTF-8 bytes; none for null."""
    return (text or "").encode().translate(_TABLE).split()


def plain_text(words: list) -> bytes:
    return b" " + b" ".join(words) + b" " if words else b""


class WuManber:
    """Search for byte patterns of at least ``BLOCK`` bytes, or shorter ones with a smaller block."""

    def __init__(self, patterns: list):
        self.patterns = patterns
        self.shortest = min(map(len, patterns))
        self.block = min(BLOCK, self.shortest)
        self.suffix = min(24, self.shortest)
        self.shift = np.full(1 << TABLE_BITS, self.shortest - self.block + 1, np.int32)
        joined = np.frombuffer(b"".join(patterns) + bytes(8), np.uint8)
        ends = np.cumsum([len(p) for p in patterns])
        for back in range(self.shortest - self.block, -1, -1):
            # The block that ends ``back`` bytes before the end of the shortest prefix all patterns have in common.
            at = ends - np.array([len(p) for p in patterns]) + self.shortest - back - self.block
            self.shift[self._block_hash(joined, at)] = np.minimum(self.shift[self._block_hash(joined, at)], back)
        self.buckets = defaultdict(list)
        starts = ends - np.array([len(p) for p in patterns])
        for i, h in enumerate(self._suffix_hash(joined, starts + self.shortest).tolist()):
            self.buckets[h].append(i)
        self.keys = np.array(sorted(self.buckets), np.uint64)

    def _word(self, data, at, n):
        value = np.zeros(len(at), np.uint64)
        for k in range(n):
            value = value << np.uint64(8) | data[at + k]
        return value

    def _block_hash(self, data, at):
        return (self._word(data, at, self.block) * _MIX >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _suffix_hash(self, data, end):
        """Hash of the last bytes before ``end``."""
        value, left = np.zeros(len(end), np.uint64), self.suffix
        while left:
            n = min(8, left)
            value = (value ^ self._word(data, end - left, n)) * _MIX
            value ^= value >> np.uint64(29)
            left -= n
        return value

    def find(self, text: bytes) -> list:
        """[(pattern number, start)] of all occurrences, in order of the start for each lane."""
        data = np.frombuffer(text + bytes(8), np.uint8)
        n, found = len(text), []
        # A lane owns the places where the first ``shortest`` bytes of an occurrence may end.
        place = np.arange(self.shortest, n + 1, LANE)
        stop = np.minimum(place + LANE, n + 1)
        while len(place):
            shift = self.shift[self._block_hash(data, place - self.block)]
            hit = np.flatnonzero(shift == 0)
            if len(hit):
                ends = place[hit]
                hashes = self._suffix_hash(data, ends)
                at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
                for end, h in zip(ends[self.keys[at] == hashes].tolist(), hashes[self.keys[at] == hashes].tolist()):
                    start = end - self.shortest
                    found += [(i, start) for i in self.buckets[h] if text.startswith(self.patterns[i], start)]
            place = place + np.maximum(shift, 1)
            going = place < stop
            place, stop = place[going], stop[going]
        return found


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """(item, pattern binary): the windows of each item, with its id as a string."""
    source = renamed(items, id=id_col, text=text_col)
    schema = StructType().add("item", "string").add("pattern", "binary")

    def cut(batches):
        kinds = arrow_schema(schema)
        for batch in batches:
            names, patterns = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                for at in range(max(1, len(words) - window + 1) if words else 0):
                    names.append(item)
                    patterns.append(plain_text(words[at:at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(patterns, pa.binary())], schema=kinds)

    return source.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(cut, schema).distinct()


def _search(docs: DataFrame, block) -> DataFrame:
    """``docs`` (.., text, ..) and n_words, starts, lengths, patterns: hit word runs and the ids of the patterns of
    a block found. ``block`` is a broadcast (pattern ids, patterns)."""
    schema = StructType([*docs.schema.fields, *_FOUND.fields])
    held = {}

    def run(batches):
        kinds = arrow_schema(schema)
        names, patterns = block.value
        sizes = [p.count(b" ") - 1 for p in patterns]
        if patterns and not held:
            # Short patterns allow short jumps only, so they are searched apart.
            for part in ([i for i, p in enumerate(patterns) if (len(p) < 32) == short] for short in (True, False)):
                if part:
                    held[len(held)] = part, WuManber([patterns[i] for i in part])
        for batch in batches:
            texts = batch.column("text").to_pylist()
            out = {"n_words": [0] * len(texts), **{n: [[] for _ in texts] for n in ("starts", "lengths", "patterns")}}
            at = 0
            while at < len(texts):
                held_bytes, group, words_of = 0, at, []
                while at < len(texts) and (held_bytes < SEARCH_BYTES or at == group):
                    words_of.append(plain_words(texts[at]))
                    held_bytes += len(texts[at] or "")
                    at += 1
                plain = [plain_text(w) for w in words_of]
                begins = np.cumsum([0, *[len(p) + 1 for p in plain]])
                text = b"\n".join(plain)
                for k, words in enumerate(words_of):
                    out["n_words"][group + k] = len(words)
                found = [(part[i], start) for part, search in held.values() for i, start in search.find(text)]
                if not found:
                    continue
                spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                owner = np.searchsorted(begins, [s for _, s in found], side="right") - 1
                index = np.searchsorted(spaces, [s for _, s in found]) - np.searchsorted(spaces, begins[owner])
                hits = defaultdict(list)
                for (i, _), k, first in zip(found, owner.tolist(), index.tolist()):
                    hits[group + k].append((i, first))
                for k, pairs in hits.items():
                    starts, ends = spans_of(cover(out["n_words"][k], [f for _, f in pairs], [sizes[i] for i, _ in pairs]))
                    out["starts"][k], out["lengths"][k] = starts, ends - starts
                    out["patterns"][k] = [names[i] for i in {i for i, _ in pairs}]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(out[n], kinds.field(n).type) for n in _FOUND.names]], schema=kinds)
        tidy()

    return docs.mapInArrow(run, schema)


def _marked(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int, block_bytes: int,
            null_items: bool):
    """(rows, owners): rows (row, id, text, n_words, starts, lengths, patterns) of ``docs``, ``id`` being a struct of
    the other columns, and owners (pattern_id, item)."""
    spark = docs.sparkSession
    items = items if null_items else items.where(F.col(f"`{item_id}`").isNotNull())
    windows = stage(benchmark_windows(items, item_id, item_text, window), "windows")
    patterns = stage(windows.select("pattern").distinct().withColumn("pattern_id", F.monotonically_increasing_id()), "patterns")
    owners = stage(windows.join(patterns, "pattern").select("pattern_id", "item"), "pattern-items")
    total = patterns.agg(F.sum(F.length("pattern") + BYTES_PER_PATTERN).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total * 5 // 4 // block_bytes))
    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("id"), F.col(f"`{text_col}`").alias("text"))

    def searched(source, number):
        rows = patterns.where(F.expr(f"pmod(xxhash64(pattern), {blocks}) = {number}")).collect()
        block = spark.sparkContext.broadcast(([r["pattern_id"] for r in rows], [bytes(r["pattern"]) for r in rows]))
        del rows
        found = _search(source, block)
        found = stage(found if number == 0 else found.where("size(lengths) > 0").drop("text", "n_words"), "block-hits")
        block.destroy()
        return found

    first = searched(source, 0)
    if blocks == 1:
        return first, owners
    more = None
    for number in range(1, blocks):
        found = searched(first.select("row", "text"), number)
        more = found if more is None else more.unionByName(found)
    more = more.groupBy("row").agg(*[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in ("starts", "lengths", "patterns")])
    joined = first.join(more, "row", "left")
    merge = F.udf(_merged, _RUNS)
    runs = F.when(F.col("more_starts").isNull(), F.struct("starts", "lengths")).otherwise(
        merge("n_words", F.concat("starts", "more_starts"), F.concat("lengths", "more_lengths")))
    none = F.expr("cast(array() as array<bigint>)")
    return joined.withColumns({
        "runs": runs, "patterns": F.concat("patterns", F.coalesce("more_patterns", none))}).select(
        "row", "id", "text", "n_words", "runs.starts", "runs.lengths", "patterns"), owners


def _merged(n_words, starts, lengths):
    if starts is None:  # no hit in a later block
        return None
    starts, ends = spans_of(cover(n_words, starts, lengths))
    return starts.tolist(), (ends - starts).tolist()


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW,
                       block_bytes: int = PATTERN_BYTES_PER_BLOCK, null_items: bool = False) -> DataFrame:
    """The columns of ``docs`` and n_words, starts, lengths, items: runs of hit words, and the items found, per row.

    Patterns go to the tasks in blocks whose bytes are counted first; the hits of a block are staged before the next
    one is read, so the driver and the tasks hold one block at a time. Only pattern ids are searched for; a join
    gives their items. Null and empty texts have no words. Items without words are left out; rows of items
    with the same id count as one item. With ``null_items`` the items with a null id are searched for like others and
    are together one null in ``items``, else they are left out. Each document row gives one row, also with a null or
    repeated id. Columns of ``docs`` with the name of a new column are replaced.
    """
    rows, owners = _marked(docs, items, text_col, item_id, item_text, window, block_bytes, null_items)
    hits = rows.where("size(patterns) > 0").select("row", F.explode("patterns").alias("pattern_id"))
    named = hits.join(owners, "pattern_id").groupBy("row").agg(
        F.transform(F.sort_array(F.collect_set(F.struct("item"))), lambda x: x["item"]).alias("items"))
    new = ("n_words", "starts", "lengths", "items")
    result = rows.join(named, "row", "left").withColumn("items", F.coalesce("items", F.expr("cast(array() as array<string>)")))
    kept = [c for c in docs.columns if c not in new]
    return result.select(*[F.col("text").alias(c) if c == text_col else F.col("id")[c].alias(c) for c in kept], *new)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = WINDOW, block_bytes: int = PATTERN_BYTES_PER_BLOCK,
                      null_items: bool = False) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item, with their own columns only."""
    rows, _ = _marked(docs, items, text_col, item_id, item_text, window, block_bytes, null_items)
    return rows.where(F.size("lengths") == 0).select(
        *[F.col("text").alias(c) if c == text_col else F.col("id")[c].alias(c) for c in docs.columns])
