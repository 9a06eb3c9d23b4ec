"""Chat formatting from every participant's point of view.

For each participant of a conversation the dialogue is rendered once, with that speaker as the assistant and all
others as named users. Masks mark the characters that the assistant is to learn. Long conversations come in parts
of a bounded number of turns, with places counted through all parts, so no row or task holds a whole long one.
"""

from pyspark.sql import DataFrame, Window, functions as F

from basketry.llm.common import renamed, stage

TURNS_PER_PART = 256


def _ordinals(turns: DataFrame) -> DataFrame:
    """``turns`` with ``pos``, the place in its conversation, from a sorted range partitioning and carried counts.

    A conversation may lie across many tasks: each task numbers its own rows, and the counts of earlier tasks are
    added for the conversations that continue.
    """
    order = ["turn", "role", "text"]
    sorted_rows = turns.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
    numbered = stage(sorted_rows.withColumn("part", F.spark_partition_id()).withColumn(
        "row", F.monotonically_increasing_id()), "turns")
    # Rows of a conversation are consecutive in a task, so the place follows from the first row there.
    firsts = numbered.groupBy("conv", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = firsts.select(F.col("conv").alias("c"), F.col("part").alias("p"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    joined = numbered.join(base, (F.col("part") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c")))
    return joined.select("conv", "role", "text", F.expr("base + row - first").alias("pos"))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """(conv_col, perspective, part, n_turns, start, text, masks): the parts of each rendering, in order.

    A turn is rendered as ``<|assistant|>\\n{text}\\n`` for the participant and as ``<|user|>{name}\\n{text}\\n``
    for any other. ``start`` is the number of characters before the part, and ``masks`` holds (start, end) for the
    text and line end of each assistant turn, counted through all parts. A null text is empty, a null role is the
    participant ``unknown``, rows with a null conversation form one conversation. Turns are taken by number, then
    role, then text, nulls first; repeated turns are all kept. Other columns are not read. No rows give no rows.
    """
    source = renamed(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).select(
        "conv", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = stage(_ordinals(source).withColumn("part", F.expr(f"pos div {turns_per_part}")), "places")
    people = placed.groupBy("conv", "role").count().select(F.col("conv").alias("c"), F.col("role").alias("perspective"))
    # A row per part first: only bounded parts meet the participants of their conversation.
    line = lambda role: F.concat(F.lit("<|user|>"), role, F.lit("\n"))
    parts = placed.groupBy("conv", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "role", "text"))).alias("turns"))
    seen = parts.join(people, F.col("conv").eqNullSafe(F.col("c")))
    rendered = seen.withColumn("pieces", F.transform("turns", lambda t: F.when(
        t["role"] == F.col("perspective"), F.struct(
            F.lit("<|assistant|>\n").alias("head"), F.concat(t["text"], F.lit("\n")).alias("body"), F.lit(True).alias("own"))).otherwise(
        F.struct(line(t["role"]).alias("head"), F.concat(t["text"], F.lit("\n")).alias("body"), F.lit(False).alias("own")))))
    sized = rendered.withColumns({
        "content": F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), ""),
        "n_turns": F.size("pieces")})
    sized = sized.withColumn("masks", F.aggregate(
        "pieces", F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("found")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(p["own"], F.concat(acc["found"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"),
                (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end"))))).otherwise(acc["found"]).alias("found")))["found"])
    lengths = placed.groupBy("conv", "part", "role").agg(
        F.count("*").alias("n"), F.sum(F.length("text") + 1).alias("chars"))
    per_view = lengths.join(people, F.col("conv").eqNullSafe(F.col("c"))).groupBy("conv", "part", "perspective").agg(
        F.sum(F.expr("chars + n * if(role = perspective, 14, 9 + length(role))")).alias("size"))
    before = Window.partitionBy("conv", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_view.select(
        F.col("conv").alias("c2"), F.col("part").alias("p2"), F.col("perspective").alias("v2"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    joined = sized.join(starts, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("part") == F.col("p2")) & (F.col("perspective") == F.col("v2")))
    return joined.select(
        F.col("conv").alias(conv_col), "perspective", "part", "n_turns", "start", F.col("content").alias("text"),
        F.transform("masks", lambda m: F.struct((m["start"] + F.col("start")).alias("start"), (m["end"] + F.col("start")).alias("end"))).alias("masks"))
