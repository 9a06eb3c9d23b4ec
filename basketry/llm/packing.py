"""Best-fit packing of documents into sequences by exact-complement hashing.

Only the histogram of piece lengths, at most ``capacity`` counts, reaches the driver. There, an index of single,
pair and triple length sums finds combinations that fill a gap exactly; they are consumed in bulk under the
counts that are left, and best fit places the rest. The plan says, for each length, which ranks go to which
sequences. Pieces get their rank in a distributed way: a number inside their task and length, and the counts of
earlier tasks.
"""

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from basketry.llm.common import arrow_schema, field, map_batches, renamed, stage, tidy
from basketry.llm.tokens import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1


class _Lengths:
    """Counts by length, with the number of available pairs for every sum."""

    def __init__(self, counts, capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.capacity = capacity
        have = np.flatnonzero(self.left)
        self.pair_sums = np.zeros(2 * capacity + 1, np.int64)
        for i, a in enumerate(have):
            self.pair_sums[a + have[i + 1:]] += 1
            self.pair_sums[2 * a] += self.left[a] >= 2

    def take(self, pattern, times: int) -> None:
        for length, n in Counter(pattern).items():
            before, after = self.left[length], self.left[length] - n * times
            self.left[length] = after
            if before >= 2 > after:
                self.pair_sums[2 * length] -= 1
            if after == 0:
                others = np.flatnonzero(self.left)
                self.pair_sums[length + others[others != length]] -= 1

    def times(self, pattern) -> int:
        return min(int(self.left[length]) // n for length, n in Counter(pattern).items())

    def pair(self, total: int, largest: int, beside=()):
        """The available pair of this sum with the largest longer part, usable beside a pattern."""
        if total < 2 or not self.pair_sums[total]:
            return None
        a = np.arange(min(total - 1, largest), (total + 1) // 2 - 1, -1)
        for x in a[(self.left[a] > 0) & (self.left[total - a] > 0)]:
            found = (*beside, int(x), int(total - x))
            if self.times(found):
                return found
        return None

    def filling(self, length: int):
        """A pattern of this length and one, two or three more that fills a sequence exactly."""
        gap = self.capacity - length
        if gap <= length and self.left[gap] and self.times((length, gap)):
            return length, gap
        if found := self.pair(gap, length, (length,)):
            return found
        longest = min(gap - 2, length)
        thirds = np.arange(longest, (gap + 2) // 3 - 1, -1)
        for c in thirds[(self.left[thirds] > 0) & (self.pair_sums[gap - thirds] > 0)] if len(thirds) else ():
            if found := self.pair(gap - int(c), int(c), (length, int(c))):
                return found
        return None


def plan_patterns(counts: dict, capacity: int = CAPACITY) -> list:
    """[(((length, repeats), ...), number of sequences)] that place every piece."""
    lengths, patterns = _Lengths(counts, capacity), []
    if lengths.left[capacity]:
        patterns.append((((capacity, 1),), int(lengths.left[capacity])))
        lengths.take((capacity,), int(lengths.left[capacity]))
    for length in range(capacity - 1, capacity // 4 - 1, -1):
        while lengths.left[length] and (found := lengths.filling(length)):
            times = lengths.times(found)
            lengths.take(found, times)
            patterns.append((tuple(sorted(Counter(found).items(), reverse=True)), times))
    return patterns + _best_fit(lengths.left, capacity)


def _best_fit(left, capacity: int) -> list:
    """Longest pieces first, each to the tightest open gap; equal sequences are kept as one group."""
    groups, gaps, done = defaultdict(list), [], []

    def put(pattern, gap, times):
        if not times:
            return
        if gap == 0:
            done.append((pattern, times))
            return
        if not groups[gap]:
            insort(gaps, gap)
        groups[gap].append((pattern, times))

    for length in range(capacity - 1, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                put(((length, each),), capacity - each * length, n // each)
                if n % each:
                    put(((length, n % each),), capacity - n % each * length, 1)
                break
            gap = gaps[at]
            pattern, times = groups[gap].pop()
            if not groups[gap]:
                gaps.pop(at)
            each = gap // length
            used = min(times, n // each)
            if used:
                put((*pattern, (length, each)), gap - each * length, used)
                put(pattern, gap, times - used)
                n -= used * each
            else:
                put((*pattern, (length, n)), gap - n * length, 1)
                put(pattern, gap, times - 1)
                n = 0
    return done + [x for found in groups.values() for x in found]


def plan_slots(patterns: list) -> dict:
    """Arrays (length, rank, repeats, sequence, offset), one row per run of equal pieces in a pattern, by length and rank."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length, repeats in pattern:
            rows.append((length, used[length], repeats, sequence, offset))
            used[length] += repeats * times
            offset += length * repeats
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "repeats", "sequence", "offset"), columns))


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, capacity: int = CAPACITY,
               end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, local_rank[, ids]): the token pieces of every row.

    ``part`` is the task and ``local_rank`` the number of the piece among those of its length in the task; both
    are fixed by staging the result.
    """
    source = renamed(docs, id=id_col, text=text_col)
    types = [("piece", IntegerType()), ("start", LongType()), ("length", LongType()), ("ids_crc32", LongType()),
             ("part", IntegerType()), ("local_rank", LongType())]
    schema = StructType([field(source, "id"), *[StructField(n, t) for n, t in types]])
    if keep_ids:
        schema = schema.add("ids", "binary")

    def run(batches):
        encode, seen, part = encoder(path), Counter(), TaskContext.get().partitionId()
        kinds, end = arrow_schema(schema), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows, owner = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    chunk = ids[at:at + 4 * capacity]
                    length = len(chunk) // 4
                    owner.append(i)
                    rows.append((piece, at // 4, length, zlib.crc32(chunk), part, seen[length], *[chunk] * keep_ids))
                    seen[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)),
                     *[pa.array(x, kinds.types[k + 1]) for k, x in enumerate(zip(*rows))]], schema=kinds)
        tidy(keep_encoder=True)

    return source.mapInArrow(run, schema)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (staged; length, part, local_rank) with sequence_id and offset."""
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(plan_patterns(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.expr("base + local_rank"))
    width = int(max([0, *slots["rank"]])) + 1
    keys = slots["length"] * width + slots["rank"]

    names = ranked.columns

    def place(batch):
        length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
        at = np.searchsorted(keys, length * width + np.minimum(rank, width - 1), side="right") - 1
        inside = rank - slots["rank"][at]
        out = {n: batch.column(n) for n in names}
        return out | {"sequence_id": slots["sequence"][at] + inside // slots["repeats"][at],
                      "offset": slots["offset"][at] + inside % slots["repeats"][at] * length}

    schema = StructType([*ranked.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return map_batches(ranked, place, schema, keep_encoder=True).drop("part", "local_rank", "base", "rank")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = None,
                   capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece.

    A null or empty text is a document of the end id only. Every row is a document of its own, also with a
    repeated or null id. An empty table gives no rows. Other columns are not read.
    """
    pieces = stage(cut_pieces(docs, id_col, text_col, path or tokenizer_path(), capacity, end_id, keep_ids), "pieces")
    return place_pieces(pieces, capacity).withColumnRenamed("id", id_col)
