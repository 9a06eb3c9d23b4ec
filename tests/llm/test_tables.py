"""The archive, the perspectives, the vectors, the pipeline and the SQL of the catalog."""

import base64
import glob
import hashlib
import os
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import catalog, cover_tree, perspectives, warc
from basketry.llm.common import table
from basketry.llm.components import components
from tools.check_queries import rows_of


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df, result = catalog.queries()[name](spark, sf_dir), db.execute(catalog.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_archive_round_trip(spark):
    rows = [(1, "u1", "same"), (2, "u2", "same"), (5, None, "same"), (3, "u\r\n3", None), (4, "u4", ""), (6, "u6", "é" * 5),
            (7, "u7", "twice"), (7, "u7", "twice"), (None, "u8", "same"), (None, None, "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("id", "n", "seq", "payload")})
    archive = warc.write_archive(pages)
    assert archive.payloads(spark).count() == 5
    got = warc.read_records(spark, archive).collect()
    kind = Counter((r["id"], r["record_type"], r["refers_to"]) for r in got)
    assert kind == Counter([(1, "revisit", 5), (2, "revisit", 5), (5, "response", None), (None, "revisit", 5), (3, "revisit", 4),
                            (4, "response", None), (6, "response", None), (7, "response", None), (7, "revisit", 7), (None, "response", None)])
    digests = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): len((h or "").encode()) for _, _, h in rows}
    assert {(r["payload_digest"], r["payload_bytes"]) for r in got} == set(digests.items())
    whole = warc.reconstruct(spark, archive).collect()
    assert Counter((r["id"], bytes(r["payload"])) for r in whole) == Counter((i, (h or "").encode()) for i, _, h in rows)
    for r in whole:
        head, block = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert block.endswith(b"\r\n\r\n") and int(head.rsplit(b": ", 1)[1]) == len(block) - 4
    small = warc.read_records(spark, warc.write_archive(pages, least_bytes=5)).collect()
    assert Counter(r["record_type"] for r in small) == Counter(response=9, revisit=1)
    assert warc.read_records(spark, warc.write_archive(pages.where("false"))).count() == 0


def plain_rotation(rows):
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[c].append((turn is not None, turn or 0, role or "unknown", text or ""))
    for c, turns in talks.items():
        for who in {t[2] for t in turns}:
            out, masks = "", []
            for _, _, role, text in sorted(turns):
                out += "<|assistant|>\n" if role == who else f"<|user|>{role}\n"
                if role == who:
                    masks.append((len(out), len(out) + len(text) + 1))
                out += text + "\n"
            yield c, who, out, tuple(masks)


@pytest.mark.parametrize("turns_per_part", [1, 3, 256])
def test_perspectives(spark, turns_per_part):
    rows = [(1, 0, "user", "hi"), (1, 1, "ann", "héllo"), (1, 2, "bob", None), (1, 3, "user", ""), (1, 3, "user", ""), (2, None, None, "x"),
            (2, 0, "user", "y"), (None, 0, "a", "b"), (None, 1, "c", "d")] + [(3, i, f"p{i % 3}", "t" * (i % 7)) for i in range(50)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("part", "conv", "row", "start")})
    got = defaultdict(lambda: ["", ()])
    for r in perspectives.rotate_perspectives(turns, turns_per_part=turns_per_part).orderBy("conv_id", "perspective", "part").collect():
        whole = got[r["conv_id"], r["perspective"]]
        assert r["start"] == len(whole[0]) and r["n_turns"] <= turns_per_part
        whole[0] += r["text"]
        whole[1] += tuple((m["start"], m["end"]) for m in r["masks"])
    assert {(*k, *v) for k, v in got.items()} == set(plain_rotation(rows))
    assert perspectives.rotate_perspectives(turns.where("false")).count() == 0


@pytest.mark.parametrize("per_block", [1024, 7])
def test_cover_tree(spark, per_block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + rng.normal(scale=(0.02, 0.12, 0.5)[i % 3], size=8)).tolist(), [None, 1, 2][i % 7 % 3]) for i in range(120)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] + [1.0] * 7, 1), (203, [None] + [1.0] * 7, 1), (204, [], 1),
             (205, [1.0, 2.0], 1), (206, [2.0, 4.0], 1), (207, rows[1][1], 1), (207, rows[1][1], 1), (None, rows[1][1], 1), (208, [1e300, 1e-300] + [0.0] * 6, 2),
             (209, [1e-310] + [0.0] * 7, 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("row", "vec", "n", "id")})
    unit = []
    for _, v, label in rows:
        x = np.array([np.nan if y is None else y for y in v or []])
        good = len(x) and np.isfinite(x).all() and x.any() and label is not None
        unit.append((label, x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())) if good else None)
    linked = lambda a, b: a and b and a[0] == b[0] and len(a[1]) == len(b[1]) and a[1] @ b[1] >= 0.98
    n = [sum(bool(linked(a, b)) for j, b in enumerate(unit) if i != j) for i, a in enumerate(unit)]
    label = list(range(len(rows)))
    for i, a in enumerate(unit):
        for j in range(i):
            if linked(a, unit[j]):
                x, y = label[i], label[j]
                label = [min(x, y) if v in (x, y) else v for v in label]
    least = {k: min((r[0] for r, x in zip(rows, label) if x == k and r[0] is not None), default=None) for k in set(label)}
    got = cover_tree.near_duplicate_vectors(vectors, per_block=per_block).collect()
    assert Counter(map(tuple, got)) == Counter((r[0], c, least[k]) for r, c, k in zip(rows, n, label))
    assert cover_tree.near_duplicate_vectors(vectors.where("false")).count() == 0


def test_few_pairs_of_cells_are_opened(spark):
    """On clustered vectors less than a fifth of the pairs of cells is opened, and no link lies in a closed pair."""
    rng = np.random.default_rng(6)
    heads = rng.normal(size=(32, 12))
    x = heads[np.arange(1600) % 32] + rng.normal(scale=0.03, size=(1600, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = [2 if i % 8 == 0 else 1 for i in range(1600)]
    vectors = spark.createDataFrame([(i, label[i], v.tolist()) for i, v in enumerate(x)], "row long, label int, vec array<double>").repartition(5)
    cells, centres = cover_tree.vector_cells(vectors, per_block=50)
    opened = cover_tree.open_cells(cells, centres)
    rows = {r["row"]: (r["level"], r["cell"]) for r in cells.collect()}
    assert len(rows) == 1600 and {(label[i], level) for i, (level, _) in rows.items()} == {(1, 5), (2, 2)} and len(centres) == 32
    assert sum(map(len, opened[5])) < 0.2 * 32 * 32
    near = [(i, j) for i, j in np.argwhere(x @ x.T >= 0.98).tolist() if label[i] == label[j]]
    assert all(rows[j][1] in opened[rows[i][0]][rows[i][1]] for i, j in near)
    counts = Counter(i for i, j in near if i != j)
    table = vectors.select(F.col("row").alias("vec_id"), "label", F.col("vec").alias("embedding"))
    got = cover_tree.near_duplicate_vectors(table, per_block=50).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: counts[i] for i in range(1600)}


def test_vectors_without_clustering_are_shuffled_a_few_times_only(spark):
    """All cells are open to each other then; what is shuffled must not grow with the number of blocks. Links across blocks
    and labels of NaN are found."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 64)).astype(np.float32)
    x[1000:1010] = x[:10]
    label = [1.0 if i % 2 else float("nan") for i in range(2000)]
    vectors = spark.createDataFrame([(i, v.tolist(), label[i]) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label double").repartition(4)
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = shuffled()
    got = {r["vec_id"]: (r["n_links"], r["component"]) for r in cover_tree.near_duplicate_vectors(vectors, per_block=30).collect()}
    assert shuffled() - before < 8 * x.nbytes
    assert got == {i: (int(i < 10 or 1000 <= i < 1010), i - 1000 if 1000 <= i < 1010 else i) for i in range(2000)}


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}


def test_pipeline(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "repeated_passages", "decontamination", "packing"]
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {r["doc_id"] for r in rows}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert ids < set(texts) and len(ids) > len(texts) / 2
    assert Counter(t for i, t in texts.items() if i in ids).most_common(1)[0][1] == 1
    leaks = {r["doc_id"] for r in catalog.queries()["op1_wu_manber"](spark, sf_dir).where("contaminated").collect()}
    assert leaks and not leaks & ids
