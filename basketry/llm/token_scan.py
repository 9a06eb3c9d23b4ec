"""Token counts of documents in flat token files without an index.

A flat file is one long run of token ids in which an end-of-document id closes each document. Blocks are searched
on their own, and a prefix scan over the block totals stitches the documents that lie across blocks.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from basketry.llm.common import arrow_schema, field, map_batches, renamed, stage
from basketry.llm.tokens import encoder, tokenizer_path

END_OF_DOCUMENT = 49407
WIDTH = 2
BLOCK_TOKENS = 1 << 18
BLOCKS_PER_RUN = 1024


def write_flat(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = None,
               end_id: int = END_OF_DOCUMENT, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS):
    """Token files of ``docs``: (blocks, manifest). Each task writes one file.

    blocks (file_id, block_no, ids) holds the file as blocks of at most ``block_tokens`` ids of ``width`` bytes,
    cut without regard to documents. manifest (file_id, doc_index, id_col) only names the documents of a file;
    it has no positions. A null or empty text is a document without tokens. Marker strings in a text are text.
    """
    source, dtype = renamed(docs, id=id_col, text=text_col), f"<u{width}"
    schema = StructType([StructField("file_id", IntegerType()), StructField("block_no", LongType()),
                         StructField("ids", BinaryType()), StructField("doc_index", LongType()), field(source, "id")])
    path = path or tokenizer_path()

    def run(batches):
        encode, kinds, file_id = encoder(path, True), arrow_schema(schema), TaskContext.get().partitionId()
        held, held_bytes, block_no, doc_index, size = [], 0, 0, 0, block_tokens * width
        end = np.array([end_id], dtype).tobytes()

        def rows(blocks, names, first):
            n, m = len(blocks), len(names)
            return pa.RecordBatch.from_arrays([
                pa.array([file_id] * (n + m), pa.int32()),
                pa.array([*range(block_no, block_no + n), *[None] * m], pa.int64()),
                pa.array([*blocks, *[None] * m], pa.binary()),
                pa.array([*[None] * n, *range(first, first + m)], pa.int64()),
                pa.concat_arrays([pa.nulls(n, kinds.types[4]), names.cast(kinds.types[4])])], schema=kinds)

        for batch in batches:
            for text in batch.column(1).to_pylist():
                held.append(np.frombuffer(encode(text), "<u4").astype(dtype).tobytes() + end)
                held_bytes += len(held[-1])
            blocks, data = [], b"".join(held)
            for at in range(0, len(data) - size + 1, size):
                blocks.append(data[at:at + size])
            held = [data[len(blocks) * size:]]
            yield rows(blocks, batch.column(0), doc_index)
            block_no, doc_index = block_no + len(blocks), doc_index + batch.num_rows
        if held and held[0]:
            yield rows([held[0]], pa.nulls(0, kinds.types[4]), 0)

    written = stage(source.mapInArrow(run, schema), "flat-tokens")
    blocks = written.where("block_no is not null").select("file_id", "block_no", "ids")
    return blocks, written.where("doc_index is not null").select("file_id", "doc_index", F.col("id").alias(id_col))


def read_flat(spark: SparkSession, path: str, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file_id, block_no, ids) of flat binary token files; file_id is the path. Each file must be under 2 GB,
    as Spark's binary source reads it in one piece."""
    size = block_tokens * width
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("file_id"), F.col("content"),
        F.explode(F.expr(f"sequence(0L, cast(ceil(length / {size}) as bigint) - 1)")).alias("block_no"),
    ).where("block_no >= 0 and length(content) > 0").select(
        "file_id", "block_no", F.expr(f"substring(content, cast(block_no * {size} + 1 as int), {size})").alias("ids"))


def _scanned(blocks: DataFrame, end_id: int, width: int) -> DataFrame:
    """Each block with its number of ids and the places of the end ids in it."""
    schema = StructType([blocks.schema["file_id"], StructField("block_no", LongType())])
    schema = schema.add("n", "long").add("ends", ArrayType(IntegerType()))

    def scan(batch):
        n, ends = [], []
        for ids in batch.column("ids"):
            values = np.frombuffer(ids.as_buffer(), f"<u{width}") if ids.is_valid else np.zeros(0, np.uint8)
            n.append(len(values))
            ends.append(np.flatnonzero(values == end_id).astype(np.int32))
        return {"file_id": batch.column("file_id"), "block_no": batch.column("block_no"), "n": n, "ends": ends}

    return map_batches(blocks.select("file_id", F.col("block_no").cast("long").alias("block_no"), "ids"), scan, schema, keep_encoder=True)


def count_tokens(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, width: int = WIDTH,
                 blocks_per_run: int = BLOCKS_PER_RUN) -> DataFrame:
    """(file_id, doc_index, start, n_tokens, closed), one row per document of each file.

    n_tokens leaves out the end id. Tokens after the last end id are a document that is not closed; nothing
    follows where the file ends with an end id. Two end ids in a row are an empty document. Null blocks hold
    nothing; no blocks give no rows. The scan has two levels: totals of runs of blocks, then blocks inside a run,
    so that a single long file is spread over many tasks.
    """
    scanned = stage(_scanned(blocks, end_id, width), "block-ends").withColumn(
        "run", F.expr(f"block_no div {blocks_per_run}"))
    totals = {"tokens": "sum(n)", "docs": "sum(size(ends))"}
    runs = scanned.groupBy("file_id", "run").agg(*[F.expr(e).alias(n) for n, e in totals.items()])
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = lambda columns, w: {f"{c}_before": F.coalesce(F.sum(e).over(w), F.lit(0)) for c, e in columns}
    carried = runs.withColumns(sums([("tokens", F.col("tokens")), ("docs", F.col("docs"))], before("file_id", "run")))
    carried = carried.select("file_id", "run", F.col("tokens_before").alias("run_tokens"), F.col("docs_before").alias("run_docs"))
    inside = before("file_id", "run", "block_no")
    placed = scanned.withColumns(sums([("tokens", F.col("n")), ("docs", F.size("ends"))], inside)).join(
        carried, ["file_id", "run"]).withColumns({
            "base": F.expr("tokens_before + run_tokens"), "first": F.expr("docs_before + run_docs")})
    closed = placed.select("file_id", "base", "first", F.posexplode("ends").alias("k", "at"), "ends").select(
        "file_id", F.expr("first + k").alias("doc_index"), F.expr("base + at").alias("at"),
        F.expr("if(k > 0, base + ends[k - 1] + 1, null)").alias("start"))
    # The first document of a block starts after the last end id of an earlier block, found by a second scan.
    last = placed.where("size(ends) > 0").select(
        "file_id", F.expr("first + size(ends)").alias("doc_index"),
        F.expr("base + element_at(ends, -1) + 1").alias("after"))
    whole = closed.join(last, ["file_id", "doc_index"], "left").select(
        "file_id", "doc_index", F.expr("coalesce(start, after, 0)").alias("start"), "at").select(
        "file_id", "doc_index", "start", F.expr("at - start").alias("n_tokens"), F.lit(True).alias("closed"))
    ended = placed.groupBy("file_id").agg(
        F.sum("n").alias("size"), F.max(F.expr("if(size(ends) > 0, first + size(ends), 0)")).alias("doc_index"),
        F.max(F.expr("if(size(ends) > 0, base + element_at(ends, -1) + 1, 0)")).alias("start"))
    tail = ended.where("size > start").select(
        "file_id", "doc_index", "start", F.expr("size - start").alias("n_tokens"), F.lit(False).alias("closed"))
    return whole.unionByName(tail)


def document_token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = None,
                          end_id: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(id_col, file_id, doc_index, start, n_tokens): documents written to flat token files and counted from there."""
    blocks, manifest = write_flat(docs, id_col, text_col, path, end_id, block_tokens=block_tokens)
    counted = count_tokens(blocks, end_id)
    return manifest.join(counted, ["file_id", "doc_index"]).select(id_col, "file_id", "doc_index", "start", "n_tokens")
