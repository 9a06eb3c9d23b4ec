"""Windows of text that occur more than once, found without moving whole texts or all windows.

Windows of a fixed size are taken together in runs: consecutive windows with the same anchor, where the anchor of
a window depends on the window's content only. All windows of a run hold a common core. A window can only occur
again in a run with an equal core, so:

1. runs whose core occurs once are dropped, by two columns of digests;
2. equal runs (same core, same bytes) are settled together, by their digests;
3. only where a core has runs that differ, one copy of each is cut into shorter runs, which are treated in the
   same way, and at last into single windows.

Texts are stored once each, bucketed by their key, so that later steps meet them without another shuffle.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from basketry.llm.common import arrow_schema, keep_bucketed, stage, text_key, tidy

LAST = (1 << 63) - 1
KINDS_PER_BUCKET = 1000
BYTES_AT_ONCE = 2 << 20
RUN = StructType([StructField("core", LongType()), StructField("rid", LongType()), StructField("tid", LongType()),
                  StructField("weight", LongType()), StructField("start", IntegerType()), StructField("n", IntegerType())])
PART = StructType([*RUN.fields, StructField("up_core", LongType()), StructField("up_rid", LongType()),
                   StructField("place", IntegerType())])
WINDOW = StructType([StructField("w", BinaryType()), StructField("weight", LongType()), StructField("up_core", LongType()),
                     StructField("up_rid", LongType()), StructField("place", IntegerType())])


PACKED = StructType([StructField("core", LongType()), StructField("rid", LongType()), StructField("weight", LongType()),
                     StructField("packed", BinaryType())])
HIT = StructType([StructField("core", LongType()), StructField("rid", LongType()), StructField("part_place", IntegerType()),
                  StructField("n", IntegerType())])


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, tid, text, copies, least): each text once, with the number of its rows and its smallest id.

    Null is the empty text. Ids are whole numbers; a null id counts as the largest.
    """
    source = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"),
                         F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    grouped = source.groupBy(text_key(F.col("text")).alias("key")).agg(
        F.any_value("text").alias("text"), F.count("*").alias("copies"), F.min("id").alias("least"))
    return keep_bucketed(grouped.withColumn("tid", F.monotonically_increasing_id()), "texts", "key")


def each_alone(find_runs):
    """Runs of several texts by a function for one, ``find_runs(text)``."""
    def runs_of(texts, cores_only):
        found = [find_runs(t) for t in texts]
        core, rid, start, n = (np.concatenate(c) for c in zip(*found))
        return core, rid, np.repeat(np.arange(len(found)), [len(f[0]) for f in found]), start, n

    return runs_of


def _run_rows(texts: DataFrame, weight: str, find_runs, cores_only: bool = False) -> DataFrame:
    """One row per run, or its core alone. ``find_runs(texts, cores_only)`` gives the arrays (core, rid, number of the text,
    start, n) of several texts; with ``cores_only`` all but the first may be None."""

    def run(batches):
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy().cumsum()
            at = 0
            while at < batch.num_rows:
                before = lengths[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(lengths, before + BYTES_AT_ONCE, side="right")))
                part, at = batch.slice(at, end - at), end
                core, rid, owner, start, n = find_runs(part.column(2).to_pylist(), cores_only)
                if cores_only:
                    columns = [core.view(np.int64)]
                else:
                    tid, w = (part.column(i).to_numpy()[owner] for i in (0, 1))
                    columns = [core.view(np.int64), rid.view(np.int64), tid, w, start.astype(np.int32), n.astype(np.int32)]
                for row in range(0, len(core), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[row:row + 50_000]) for c in columns], schema=kinds)
        tidy()

    schema = StructType(RUN.fields[:1]) if cores_only else RUN
    kinds = arrow_schema(schema)
    return texts.select("tid", weight, "text").mapInArrow(run, schema)


def _by_text(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts with the list of each ``tid``; only the lists are shuffled."""
    return texts.join(lists.join(texts.select("tid", "key"), "tid").drop("tid"), "key", how)


def _from_asked(texts: DataFrame, asked: DataFrame, schema: StructType, cut) -> DataFrame:
    """Rows that ``cut(text, runs)`` makes of one copy of each run in ``asked``; a dict of columns for each text."""
    lists = asked.groupBy(F.col("one.tid").alias("tid")).agg(
        F.collect_list(F.struct("one.tid", "one.start", "one.n", "core", "rid", "total")).alias("runs"))

    def run(batches):
        kinds = arrow_schema(schema)
        for batch in batches:
            for k in range(batch.num_rows):
                columns = cut(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                whole = pa.RecordBatch.from_arrays([pa.array(columns[n], kinds.field(n).type) for n in schema.names], schema=kinds)
                for at in range(0, whole.num_rows, 50_000):
                    yield whole.slice(at, 50_000)

    return _by_text(texts, lists, "inner").select("text", "runs").mapInArrow(run, schema)


def _parts(cut_runs):
    """Shorter runs of some runs. ``cut_runs(bytes of the text, start, n)`` gives the arrays (core, rid, start, n)."""

    def cut(text, runs):
        out, data = {name: [] for name in PART.names}, text.encode()
        for r in runs:
            core, rid, start, n = cut_runs(data, r["start"], r["n"])
            same = {"tid": r["tid"], "weight": r["total"], "up_core": r["core"], "up_rid": r["rid"]}
            for name, value in same.items():
                out[name] += [value] * len(core)
            for name, value in (("core", core.view(np.int64)), ("rid", rid.view(np.int64)), ("start", start), ("n", n), ("place", start - r["start"])):
                out[name] += value.tolist()
        return out

    return cut


def _windows(window_keys):
    def cut(text, runs):
        places = [(r["total"], r["core"], r["rid"], k) for r in runs for k in range(r["n"])]
        columns = zip(*places) if places else ((), (), (), ())
        return {"w": window_keys(text, [(r["start"], r["n"]) for r in runs])} | dict(zip(WINDOW.names[1:], columns))

    return cut


def _packed(pack):
    def cut(text, runs):
        return {"core": [r["core"] for r in runs], "rid": [r["rid"] for r in runs], "weight": [r["total"] for r in runs],
                "packed": pack(text, [(r["start"], r["n"]) for r in runs])}

    return cut


def _in_buckets(packed: DataFrame, count, unpack) -> DataFrame:
    """(core, rid, part_place, n): windows of packed runs that a run of smaller order in the bucket also has.

    A bucket is a core. Buckets of at most ``KINDS_PER_BUCKET`` runs are sorted whole; the windows of larger ones
    are dealt out one by one.
    """
    sizes = packed.groupBy("core").agg(F.count("*").alias("kinds"))
    large = sizes.where(f"kinds > {KINDS_PER_BUCKET}").select("core")
    buckets = packed.join(large, "core", "left_anti").groupBy("core").agg(F.collect_list(F.struct("rid", "weight", "packed")).alias("runs"))

    def sort(batches):
        kinds = arrow_schema(HIT)
        for batch in batches:
            rows = []
            for core, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(core, runs[i]["rid"], k, 1) for i, k in count([(r["weight"], r["packed"]) for r in runs])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    def deal(batches):
        out = arrow_schema(WINDOW)
        for batch in batches:
            rows = [(w, weight, core, rid, k) for core, rid, weight, packed in zip(*(batch.column(i).to_pylist() for i in range(4)))
                    for k, w in enumerate(unpack(packed))]
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 50_000]), out.types)], schema=out)

    single = stage(packed.join(large, "core", "left_semi").mapInArrow(deal, WINDOW), "windows")
    least = single.groupBy("w").agg(F.min("weight").alias("least"))
    dealt = single.join(least, "w").where("weight > least").select(
        F.col("up_core").alias("core"), F.col("up_rid").alias("rid"), F.col("place").alias("part_place"), F.lit(1).alias("n"))
    return buckets.mapInArrow(sort, HIT).unionByName(dealt)


def repeated_windows(texts: DataFrame, weight: str, find_runs, cuts: list, window_keys, by_order: bool,
                     count_bucket=None, unpack=None) -> DataFrame:
    """(tid, marks): for each text with repeated windows, the runs of them as (start, n).

    With ``by_order`` false, ``weight`` is a number of copies, and windows that occur twice or more are marked.
    With it true, ``weight`` is an order, and windows that also occur in a text of smaller order are marked.
    ``cuts`` are functions for shorter and shorter runs. Last, ``window_keys(text, [(start, n)])`` gives the bytes
    that identify each window of some runs; or, with ``count_bucket``, the runs packed, which travel to their bucket.
    """
    total = F.min if by_order else F.sum
    settled = "weight > total" if by_order else "total > 1"
    unsettled = "max(total) > min(total)" if by_order else "min(total) = 1"

    def settle(rows, again, keys, at, level) -> DataFrame:
        """(*keys, at, n): repeated windows of ``again``, counted from ``at``. ``rows`` are the same or have less columns."""
        times = F.count("*") if by_order else F.sum("weight")
        cores = rows.groupBy("core").agg(times.alias("times")).where("times > 1").select("core")
        shared = stage(again.join(cores, "core", "left_semi"), "shared-runs")
        kinds = stage(shared.groupBy("core", "rid").agg(
            total("weight").alias("total"), F.min(F.struct("tid", "start", "n")).alias("one")), "run-kinds")
        mixed = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.expr(unsettled).alias("open")).where(
            "kinds > 1 and open").select("core")
        found = refine(kinds.join(mixed, "core", "left_semi"), level)
        whole = shared.join(kinds.select("core", "rid", "total"), ["core", "rid"])
        return whole.where(settled).select(*keys, at, "n").unionByName(
            whole.where(f"not ({settled})").drop("n").join(found, ["core", "rid"]).select(
                *keys, F.expr(f"{at} + part_place").alias(at), "n"))

    def refine(asked, level) -> DataFrame:
        """(core, rid, part_place, n): repeated windows inside the runs ``asked``."""
        if level < len(cuts):
            parts = stage(_from_asked(texts, asked, PART, _parts(cuts[level])), "run-parts")
            found = settle(parts, parts, ["up_core", "up_rid"], "place", level + 1)
        elif count_bucket:
            return _in_buckets(stage(_from_asked(texts, asked, PACKED, _packed(window_keys)), "packed"), count_bucket, unpack)
        else:
            single = stage(_from_asked(texts, asked, WINDOW, _windows(window_keys)), "windows")
            counted = single.groupBy("w").agg(total("weight").alias("total"))
            found = single.join(counted, "w").where(settled).select("up_core", "up_rid", "place", F.lit(1).alias("n"))
        return found.withColumnsRenamed({"up_core": "core", "up_rid": "rid", "place": "part_place"})

    # The rows of all texts are cheaper to make twice than to keep; where copies don't count, cores alone come first.
    first, second = (_run_rows(texts, weight, find_runs, cores_only) for cores_only in (by_order, False))
    marks = settle(first, second, ["tid"], "start", 0)
    return marks.groupBy("tid").agg(F.collect_list(F.struct("start", "n")).alias("marks"))


def map_texts(texts: DataFrame, marks: DataFrame, function, schema: StructType) -> DataFrame:
    """(key, copies, least, *schema): ``function(text, starts, numbers)`` gives the new columns of each text."""
    kept = StructType([texts.schema["key"], texts.schema["copies"], texts.schema["least"], *schema.fields])

    def run(batches):
        out = arrow_schema(kept)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [function(text, [m["start"] for m in found or ()], [m["n"] for m in found or ()])
                        for text, found in zip(part.column(3).to_pylist(), part.column(4).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(3)] + [pa.array(c, t) for c, t in zip(zip(*rows), out.types[3:])], schema=out)
        tidy()

    return _by_text(texts, marks, "left").select("key", "copies", "least", "text", "marks").mapInArrow(run, kept)
