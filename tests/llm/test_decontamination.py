"""Decontamination in bounded blocks, with windows that many items share."""

import hashlib

import corpus_pipeline
from basketry.llm import catalog, decontamination


def test_blocks_hold_pattern_ids_only_and_one_is_held_at_a_time(spark, make_docs, monkeypatch):
    template = " ".join(f"t{k}" for k in range(14))
    items = [(i, f"{template} " + " ".join(f"q{i}x{k}" for k in range(12))) for i in range(60)]
    source = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination.benchmark_windows(source, "item_id", "text").schema["item"].dataType.simpleString() == "string"
    docs = make_docs([(1, "before " + template), (2, items[7][1] + " after"), (3, "clean words"), (3, None), (None, items[7][1])])
    blocks, send = [], spark.sparkContext.broadcast

    class Block:
        def __init__(self, value):
            assert all(b.gone for b in blocks), "an earlier block is still held"
            self.value, self.sent, self.gone = value, send(value), False
            blocks.append(self)

        def destroy(self):
            self.gone = True
            self.sent.destroy()

        def __reduce__(self):
            return self.sent.__reduce__()

    monkeypatch.setattr(spark.sparkContext, "broadcast", Block)
    found = decontamination.find_contamination(docs, source, block_bytes=40_000)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()  # searches are staged, not chained
    ids = [i for b in blocks for i in b.value[0]]
    assert len(blocks) > 3 and all(b.gone for b in blocks) and all(type(i) is int for i in ids)
    patterns = [p for b in blocks for p in b.value[1]]
    assert len(patterns) == len(set(patterns)) == len(set(ids))
    everyone = sorted(str(i) for i in range(60))
    got = sorted(((r["doc_id"] or 0, r["n_words"], sum(r["lengths"]), r["items"]) for r in found.collect()))
    assert got == [(0, 26, 26, everyone), (1, 15, 14, everyone), (2, 27, 26, everyone), (3, 0, 0, []), (3, 2, 0, [])]
    clean = decontamination.drop_contaminated(docs, source, block_bytes=40_000)
    assert clean.columns == docs.columns and [r["doc_id"] for r in clean.collect()] == [3, 3]


def test_items_without_an_id_mark_documents_as_in_the_sql(spark, make_docs, tmp_path):
    leak, named = (" ".join(f"{c}{k}" for k in range(12)) for c in "ab")
    docs = make_docs([(1, "before " + leak), (2, named), (3, leak + " " + named), (4, "clean words"), (5, None)])
    docs.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    items = [(None, leak), (None, leak + " more"), (8, named), (9, "nothing of it"), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = {r["doc_id"]: tuple(r)[1:] for r in catalog.op1_wu_manber(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {1: (13, 12, 1, sha(""), True), 2: (12, 12, 1, sha("8"), True), 3: (24, 24, 2, sha("8"), True),
            4: (2, 0, 0, sha(""), False), 5: (0, 0, 0, sha(""), False)}
    assert rows == want
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    assert {r[0]: r[1:] for r in con.execute(catalog.OP1_SQL).fetchall()} == want
    kept = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]
