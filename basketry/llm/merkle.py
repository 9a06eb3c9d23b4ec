"""Merkle manifest of a dataset with checkpoints: of the tree, only every few levels are stored.

Every row is a leaf, every group of rows a tree, and the groups' roots are the leaves of one more tree. Building
hashes aligned subtrees of a few levels in one step and keeps their tops only. A proof is taken from the top down:
each aligned subtree is made again from its stored nodes, gives its nodes the siblings on their way up, and is
forgotten.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from basketry.llm.common import arrow_schema, field, stage

FANOUT = 8
CHECKPOINT_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(columns) -> Column:
    """SHA-256 of the values, each as ``-`` for null, else its length in UTF-8 bytes, a colon and the value."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[one(c.cast("string")) for c in columns]), 256)


def parents(nodes: list, fanout: int = FANOUT) -> list:
    return [digest(*nodes[at:at + fanout]) for at in range(0, len(nodes), fanout)]


def siblings(nodes: list, at: int, fanout: int = FANOUT) -> tuple[str, str]:
    """What stands before and after a node in its run."""
    run = at - at % fanout
    return "".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])


def fold(node: str, path: list) -> str:
    """The root that a node and the siblings on its path give."""
    for before, after in path:
        node = digest(before, node, after)
    return node


def _depth(n: Column, fanout: int) -> Column:
    """Levels above the leaves of a tree of n leaves: runs are hashed until one node remains."""
    steps = [F.when(n > fanout ** k, 1).otherwise(0) for k in range(0, 63) if fanout ** k < 1 << 62]
    return sum(steps[1:], steps[0]).cast("int")


def place_leaves(rows: DataFrame, order: list, fanout: int = FANOUT) -> DataFrame:
    """``rows`` (tree, ...) with ``pos``, the place of a row in its tree, and the tree's ``depth``.

    One range sort over all rows and counts carried over its partitions, so a tree may hold any share of the rows.
    """
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    dealt = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns(
        {"pid": F.spark_partition_id(), "mid": F.monotonically_increasing_id()}), "sorted-leaves")
    tree = Window.partitionBy("tree")
    counts = dealt.groupBy("tree", "pid").agg(F.min("mid").alias("first"), F.count("*").alias("n")).select(
        "tree", "pid", (F.sum("n").over(tree.orderBy("pid")) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total"))
    return dealt.join(counts, ["tree", "pid"]).withColumns(
        {"pos": F.col("mid") + F.col("shift"), "depth": _depth(F.col("total"), fanout)}).drop("pid", "mid", "shift", "total")


def _subtrees(nodes: DataFrame, level: int, levels: int, fanout: int, *more: str) -> DataFrame:
    """(tree, sub, depth, nodes): the stored nodes of each aligned subtree, in order, ``fanout ** levels`` at most."""
    return nodes.where(f"depth > {level} or {level} = 0").groupBy(
        "tree", F.expr(f"pos div {fanout ** levels}").alias("sub"), "depth").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", *more))).alias("nodes"))


def build(leaves: DataFrame, fanout: int = FANOUT, levels: int = CHECKPOINT_LEVELS) -> tuple[list, DataFrame]:
    """(stored levels, roots (tree, digest)) of ``leaves`` (tree, pos, depth, digest)."""
    schema = StructType([leaves.schema["tree"], leaves.schema["pos"], leaves.schema["depth"], StructField("digest", StringType())])
    nodes, stored = leaves.select("tree", "pos", "depth", "digest"), []
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    roots = nodes.where("depth = 0")
    for level in range(0, deepest, levels):
        def rise(batches, level=level):
            for part in _slices(batches):
                rows = []
                for tree, sub, depth, found in zip(*(c.to_pylist() for c in part.columns)):
                    found = [n["digest"] for n in found]
                    for _ in range(min(levels, depth - level)):
                        found = parents(found, fanout)
                    rows.append((tree, sub, depth, found[0]))
                yield _record(rows, schema)

        stored.append(nodes)
        nodes = stage(_subtrees(nodes, level, levels, fanout).where("depth > 0").mapInArrow(rise, schema), "checkpoint")
        roots = roots.unionByName(nodes.where(f"depth <= {level + levels}"))
    return stored or [nodes], roots.select("tree", "digest")


def _slices(batches):
    """A few subtrees at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 8):
            yield batch.slice(at, 8)


def _record(rows: list, schema: StructType) -> pa.RecordBatch:
    kinds = arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)


_STEP = "array<struct<before: string, after: string>>"


def _with_paths(nodes: DataFrame, level: int, above: DataFrame, levels: int, fanout: int, schema: StructType, result, *more: str) -> DataFrame:
    """Rows that ``result(tree, pos, depth, node, path, top)`` makes of every node below the subtree tops ``above``."""
    met = _subtrees(nodes, level, levels, fanout, *more).join(above.withColumnRenamed("pos", "sub"), ["tree", "sub"])

    def climb(batches):
        for part in _slices(batches):
            rows = []
            for tree, depth, found, path, top in zip(*(c.to_pylist() for c in part.columns)):
                rows_of, path = [[n["digest"] for n in found]], [(s["before"], s["after"]) for s in path]
                for _ in range(min(levels, depth - level) - 1):
                    rows_of.append(parents(rows_of[-1], fanout))
                for at, node in enumerate(found):
                    own, k = [], at
                    for nodes_of in rows_of[:max(0, min(levels, depth - level))]:
                        own.append(siblings(nodes_of, k, fanout))
                        k //= fanout
                    rows.append(result(tree, node["pos"], depth, node, own + path, top))
            yield _record(rows, schema)

    return met.select("tree", "depth", "nodes", "path", "top").mapInArrow(climb, schema)


def prove(stored: list, tops: DataFrame, leaves: DataFrame, schema: StructType, result, more: list,
          fanout: int = FANOUT, levels: int = CHECKPOINT_LEVELS) -> DataFrame:
    """Rows that ``result`` makes of every leaf and its path, from the stored levels, top down.

    ``tops`` (tree, path, top) goes on above each tree's root; ``top`` is passed on to the leaves.
    """
    tops = tops.withColumn("pos", F.lit(0).cast("long"))
    passed = StructType([stored[0].schema["tree"], stored[0].schema["pos"], StructField("path", tops.schema["path"].dataType),
                         StructField("top", tops.schema["top"].dataType)])
    above = tops
    for k in range(len(stored) - 1, -1, -1):
        level = k * levels
        if k:
            emit = lambda tree, pos, depth, node, path, top: (tree, pos, [{"before": b, "after": a} for b, a in path], top)
            found = _with_paths(stored[k], level, above, levels, fanout, passed, emit)
            # Trees that end at or below this level start here.
            low = leaves.where(f"pos = 0 and depth <= {level}").select("tree").join(tops, "tree")
            above = stage(found.unionByName(low), "paths")
        else:
            return _with_paths(leaves, 0, above, levels, fanout, schema, result, *more)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text", fields=FIELDS,
             fanout: int = FANOUT, levels: int = CHECKPOINT_LEVELS, tampered: Column = None) -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified) of each row.

    A tree for each value of ``group_col``, leaves by id; the trees' roots, by that value, under one root. Nulls come
    first in both orders; rows with one id go by their leaf digests, equal rows in any order. Where ``tampered``, the proof
    is checked with the row's text in lower-case A-Z letters; a null condition counts as false. A null or an empty text
    is a value like others. Each row gives one row; an empty table gives none. Other columns are not read.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = [F.col(f"`{c}`") for c in fields]
    changed = [F.translate(F.col(f"`{c}`"), upper, upper.lower()) if c == text_col else F.col(f"`{c}`") for c in fields]
    group = F.col(f"`{group_col}`")
    rows = stage(docs.select(
        F.coalesce(F.concat(F.lit("v"), group.cast("string")), F.lit("n")).alias("tree"), F.col(f"`{id_col}`").alias("id"),
        leaf_digest(plain).alias("digest"), F.when(tampered, leaf_digest(changed)).alias("other") if tampered is not None
        else F.lit(None).cast("string").alias("other"), F.monotonically_increasing_id().alias("row")), "leaves")
    leaves = stage(place_leaves(rows, ["id", "digest", "row"], fanout).drop("row"), "placed-leaves")
    stored, subroots = build(leaves, fanout, levels)
    heads = stage(place_leaves(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"], fanout), "subroots")
    above, roots = build(heads, fanout, levels)
    top_schema = StructType([StructField("subroot", StringType()), StructField("root", StringType())])
    start = roots.select("tree", F.expr(f"cast(array() as {_STEP})").alias("path"),
                         F.struct(F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("top"))
    head_schema = StructType([StructField("tree", StringType()), StructField("path", start.schema["path"].dataType), StructField("top", top_schema)])
    tops = stage(prove(above, start, heads, head_schema, lambda tree, pos, depth, node, path, top: (
        node["name"], [{"before": b, "after": a} for b, a in path], {"subroot": node["digest"], "root": top["root"]}), ["name"], fanout, levels), "tops")
    result = StructType([field(docs, id_col), *[StructField(c, StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                         StructField("verified", BooleanType())])

    def proof(tree, pos, depth, node, path, top):
        folded = fold(node["other"] or node["digest"], path)
        return (node["id"], node["digest"], top["subroot"], top["root"], digest(*[part for step in path for part in step]), folded, folded == top["root"])

    return prove(stored, tops, leaves, result, proof, ["id", "other"], fanout, levels)
