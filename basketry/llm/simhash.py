"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint of 64 bits has eight bytes. Two that differ in at most four bits share at least four bytes in place,
so at least one of twenty triples of places, chosen so that every four places hold one. A posting list belongs to
a triple and its three byte values. In a list, shared bytes in place are counted for each pair, pairs with at
least four are kept and verified bit by bit. Equal fingerprints collapse first, and a list gives only a spanning
forest of its links, so a large group of near copies never becomes all its pairs.
"""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from basketry.llm.common import map_batches, stage
from basketry.llm.components import components, star_links

SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
ROWS_PER_BLOCK = 2048
SMALL_PIECE = 1 << 22

_TABLE = bytes(c + 32 if 65 <= c < 91 else 32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def fingerprint(text, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the lower-cased text's word shingles; zero for null or no words."""
    tokens = (text or "").encode().translate(_TABLE).split(b" ")
    tokens = [t for t in tokens if t]
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    lasts = ends[words - 1:] if len(tokens) >= words else ends[-1:]
    for at in range(0, n, 65536):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:min(n, at + 65536)].tolist(), lasts[at:at + 65536].tolist())], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp``, the fingerprint as a signed long."""
    others = [c for c in docs.columns if c not in (text_col, "fp")]
    source = docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text_col}`").alias("fp"))
    schema = StructType([*[source.schema[c] for c in others], StructField("fp", LongType())])

    def work(batch):
        values = np.array([fingerprint(t) for t in batch.column(len(others)).to_pylist()], np.uint64)
        return {c: batch.column(i) for i, c in enumerate(others)} | {"fp": values.view(np.int64)}

    return map_batches(source, work, schema)


def covering_triples() -> list:
    """Twenty triples of the eight byte places such that every four places hold at least one of them: places in
    three groups; a triple inside a group, or two places of a group and one of the next."""
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    chosen = []
    for t in combinations(range(8), 3):
        kinds = sorted(group[i] for i in t)
        next_after = [(0, 0, 1), (1, 1, 2), (0, 2, 2)]
        if len(set(kinds)) == 1 or tuple(kinds) in next_after:
            chosen.append(t)
    return chosen


def list_links(left: np.ndarray, right: np.ndarray, same: bool, distance: int = MAX_DISTANCE) -> np.ndarray:
    """Rows (a, b) that join what the links in one block pair of a posting list join, one for each member at most."""
    found, least = [], 8 - distance
    by_left, by_right = left.view(np.uint8).reshape(-1, 8), right.view(np.uint8).reshape(-1, 8)
    step = max(1, SMALL_PIECE // max(1, 8 * len(right)))
    for at in range(0, len(left), step):
        shared = (by_left[at:at + step, None, :] == by_right[None, :, :]).sum(2, dtype=np.uint8)
        i, j = np.nonzero(shared >= least)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        near = np.bitwise_count(left[i] ^ right[j]) <= distance
        i, j = i[near], j[near]
        if len(i):
            found.append(star_links(left[i], right[j]))
    links = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
    return star_links(links[:, 0], links[:, 1]) if len(found) > 1 else links


def near_links(distinct: DataFrame, distance: int = MAX_DISTANCE, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that give the same components as all links.

    Lists longer than a block are cut by hash, and every pair of blocks is a unit of its own.
    """
    triples = covering_triples()
    byte = lambda i: F.shiftrightunsigned("fp", 8 * (7 - i)).bitwiseAND(255)
    key = lambda no, t: F.lit(no << 24).bitwiseOR(F.shiftleft(byte(t[0]), 16)).bitwiseOR(
        F.shiftleft(byte(t[1]), 8)).bitwiseOR(byte(t[2])).cast("int")
    posted = distinct.select("fp", F.explode(F.array(*[key(no, t) for no, t in enumerate(triples)])).alias("key"))
    sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "blocks", F.expr(f"cast(ceil(n / {rows_per_block}) as int)")).select("key", "blocks")
    listed = posted.join(sizes, "key").withColumn("own", F.expr("cast(pmod(xxhash64(fp), blocks) as int)"))
    units = listed.select("key", "fp", "own", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")).select(
        "key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    lists = units.groupBy("key", "i", "j").agg(
        F.collect_list(F.when(F.col("own") == F.col("i"), F.col("fp"))).alias("left"),
        F.collect_list(F.when(F.col("own") != F.col("i"), F.col("fp"))).alias("right")).where(
        "size(left) > 0 and (i = j and size(left) > 1 or size(right) > 0)")
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def compare(batch):
        lefts, rights = batch.column("left"), batch.column("right")
        links = []
        for k in range(batch.num_rows):
            left = lefts[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            right = rights[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
            same = len(right) == 0
            links.append(list_links(left, left if same else right, same, distance))
        ends = np.concatenate(links).view(np.int64)
        ends = star_links(ends[:, 0], ends[:, 1])
        return {"a": ends[:, 0], "b": ends[:, 1]}

    return map_batches(lists, compare, schema)


def group_roots(marked: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp, root): for each fingerprint of ``marked`` (fp), one fingerprint of its near-duplicate group."""
    classes = stage(marked.select("fp").distinct(), "classes")
    groups = stage(components(near_links(classes, distance)), "groups")
    return classes.join(groups, classes.fp == groups.node, "left").select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          distance: int = MAX_DISTANCE) -> DataFrame:
    """(id_col, fp, component): the fingerprint of every row and the smallest id it is linked with.

    Null and wordless texts have fingerprint zero and link like any other. Every row takes part, also with a
    repeated id. A row with a null id belongs to its group, and its component is null only where all ids of the
    group are null. An empty table gives no rows.
    """
    marked = stage(fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))), "fingerprints")
    least_of = marked.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = least_of.join(group_roots(marked, distance), "fp")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``docs``: that with the smallest id, nulls last.

    Of several rows with that id, the first written stays. A table without rows gives none.
    """
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").alias("id"),
                         F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").alias("text"))
    # Row numbers are fixed by writing them.
    marked = stage(fingerprints(source), "fingerprints")
    best = marked.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"))
    keep = best.join(group_roots(marked, distance), "fp").groupBy("root").agg(F.min("best").alias("best"))
    return marked.join(keep.select(F.col("best.row").alias("row")), "row", "left_semi").select("doc.*")
