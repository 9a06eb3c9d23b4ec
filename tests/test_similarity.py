"""Similarity, groups and clusters against plain brute force on small inputs."""

import itertools
import math
import pathlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import clusters, similarity
from basketry.operators.spread import block_sizes, grid_join

WORDS = ["choco", "bar", "milk", "dark", "nut", "mint", "cola", "diet", "zero", "lemon", "lime", "chips", "salt"]


def make_names(n, seed=1):
    rng = random.Random(seed)
    found = {" ".join(rng.choices(WORDS, k=rng.randint(1, 4))) + f" {rng.randint(1, 30)}ml" for _ in range(n)}
    return sorted(found | {"10ml", "20ml", "choco bar 1ml", "bar choco 1ml"})


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "productName string").repartition(5)


def plain_text(name):
    return re.sub(r"\s+", " ", re.sub(r"\b\d+ml\b", "", name)).strip()


def plain_vectors(names, max_features=1000):
    grams = {}
    for name in names:
        tokens = re.findall(r"\b[a-zA-Z]{2,}\b", plain_text(name))
        grams[name] = Counter(" ".join(tokens[i:i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1))
    df, uses = Counter(), Counter()
    for c in grams.values():
        df.update(c.keys())
        uses.update(c)
    kept = sorted((t for t in df if df[t] <= 0.8 * len(names)), key=lambda t: (-uses[t], t))[:max_features]
    idf = {t: math.log((1 + len(names)) / (1 + df[t])) + 1 for t in kept}
    vectors = {}
    for name, c in grams.items():
        v = {t: c[t] * idf[t] for t in c if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors[name] = {t: x / norm for t, x in v.items()} if norm else {}
    return vectors


def cosine(a, b):
    return sum(w * b.get(t, 0.0) for t, w in a.items())


def plain_groups(names, vectors, t):
    parent = {n: n for n in names}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(names, 2):
        if cosine(vectors[a], vectors[b]) >= t - 1e-9:
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    return {n: root(n) for n in names}


@pytest.fixture(scope="module")
def sample():
    names = make_names(150)
    return names, plain_vectors(names)


def test_tfidf(spark, sample):
    names, vectors = sample
    got = {(r["productName"], r["term"]): r["weight"] for r in similarity.tfidf(frame(spark, names), stop_words=[]).collect()}
    want = {(n, t): w for n, v in vectors.items() for t, w in v.items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("max_features", [12])
def test_vocabulary_is_limited(spark, sample, max_features):
    names, _ = sample
    got = {r["term"] for r in similarity.tfidf(frame(spark, names), [], max_features).select("term").distinct().collect()}
    assert got == {t for v in plain_vectors(names, max_features).values() for t in v}


def test_stop_words(spark):
    df = frame(spark, ["the choco", "choco of bar"])
    terms = {r["term"] for r in similarity.tfidf(df).collect()}
    assert terms and all("the" not in t.split() and "of" not in t.split() for t in terms)


@pytest.mark.parametrize("threshold, block", [(0.4, 2000), (0.5, 3), (0.7, 7), (0.9, 2000)])
def test_pairs_are_exact(spark, sample, threshold, block):
    names, vectors = sample
    texts = similarity.product_texts(frame(spark, names))
    v = similarity.text_vectors(texts, [])
    by_text = {plain_text(n): n for n in names}
    ids = {r["vec_id"]: by_text[r["text"]] for r in similarity.distinct_vectors(v).collect()}
    got = similarity.similar_pairs(v, threshold, rows_per_block=block).collect()
    found = {frozenset((ids[r["vec_a"]], ids[r["vec_b"]])) for r in got}
    distinct = sorted(ids.values())
    want = {frozenset(p) for p in itertools.combinations(distinct, 2) if cosine(vectors[p[0]], vectors[p[1]]) >= threshold - 1e-9}
    assert found == want and len(got) == len(want)


@pytest.mark.parametrize("threshold", [0.5, 0.7])
def test_groups_and_representatives(spark, sample, threshold):
    names, vectors = sample
    df = frame(spark, names)
    groups = similarity.group_products(df, threshold, [])
    got = {r["productName"]: r["group_id"] for r in groups.collect()}
    want = plain_groups(names, vectors, threshold)
    assert got == want
    assert got["10ml"] == "10ml" and got["20ml"] == "20ml"
    members = {}
    for n in names:
        members.setdefault(want[n], []).append(n)
    for r in similarity.group_representatives(df, groups, []).collect():
        group = members[r["group_id"]]
        assert r["group_size"] == len(group)
        if len(group) > 1:
            means = {n: round(np.mean([cosine(vectors[n], vectors[o]) for o in group if o != n]), 9) for n in group}
            assert r["representative"] == min(group, key=lambda n: (-means[n], n))


def test_neighbours(spark, sample):
    names, vectors = sample
    got = {}
    for r in similarity.similar_products(frame(spark, names), 0.5, k=4, stop_words=[]).orderBy("position").collect():
        got.setdefault(r["productName"], []).append(r["similar_product"])
    for n in names:
        scored = [(-round(cosine(vectors[n], vectors[o]), 6), o) for o in names if o != n and cosine(vectors[n], vectors[o]) >= 0.5 - 1e-9]
        assert got.get(n, []) == [o for _, o in sorted(scored)[:4]]
    one = similarity.similar_products(frame(spark, names), 0.5, k=4, product=names[3], stop_words=[])
    assert {r["productName"] for r in one.collect()} <= {names[3]}


def test_long_chain_is_one_component(spark):
    nodes = [f"{i:04}" for i in range(300)]
    random.Random(3).shuffle(nodes)
    pairs = spark.createDataFrame([(min(a, b), max(a, b)) for a, b in zip(nodes, nodes[1:])], "vec_a string, vec_b string").repartition(7)
    got = similarity.connected_components(pairs).collect()
    assert len(got) == 300 and {r["root"] for r in got} == {"0000"}


def test_hub_of_a_large_component_is_spread(spark):
    """A hub with most of 100,000 nodes and a path that ends in it: one component, and no key with over a 32nd of the links."""
    name = lambda c: F.format_string("%06d", c)
    star = spark.range(100_000).where("id <> 50000").select(name(F.lit(50000)).alias("x"), name(F.col("id")).alias("y"))
    path = spark.range(100_000, 100_040).select(name(F.col("id") - 1).alias("x"), name(F.col("id")).alias("y"))
    pairs = star.unionByName(path).select(F.least("x", "y").alias("vec_a"), F.greatest("x", "y").alias("vec_b")).repartition(6)
    links = pairs.select(F.col("vec_a").alias("u"), F.col("vec_b").alias("v"))
    spread = similarity.with_least_neighbour(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    assert spread.groupBy("u", "share").count().agg(F.max("count")).first()[0] < 100_000 / 32
    assert spread.where("u = '050000'").agg(F.min("m"), F.max("m"), F.count("*")).first() == ("000000", "000000", 99_999)
    found = similarity.connected_components(pairs).agg(F.count("*"), F.count_distinct("node"), F.min("root"), F.max("root")).first()
    assert found == (100_040, 100_040, "000000", "000000")


def test_consolidation_keeps_totals(spark):
    sales = spark.createDataFrame([("a", 5.0, 1), ("b", 7.0, 2), ("x", 1.5, 3)], "productname string, sales double, quantitysold int")
    mapping = spark.createDataFrame([("a", "b"), ("b", "b")], "productName string, representative string")
    rows = similarity.consolidate_sales(sales, mapping).orderBy("s_no").collect()
    assert [(r["product_name"], float(r["sales"]), r["quantity_sold"]) for r in rows] == [("b", 12.0, 3), ("x", 1.5, 3)]
    impact = similarity.consolidation_impact(sales, spark.createDataFrame([("b", 12.0), ("x", 1.5)], "p string, sales double")).first()
    assert (impact["reduction_pct"], impact["preserved_pct"]) == (33.3, 100.0)


def test_group_listing_is_whole(spark):
    groups = spark.createDataFrame([(f"n{i:03}", "g") for i in range(95)] + [("z", "z")], "productName string, group_id string")
    reps = spark.createDataFrame([("g", "n000", 95), ("z", "z", 1)], "group_id string, representative string, group_size bigint")
    rows = similarity.analyze_groups(groups, reps).collect()
    assert sorted((r["group_id"], r["position"], r["productName"]) for r in rows) == [
        *[("g", i + 1, f"n{i:03}") for i in range(95)], ("z", 1, "z")]


def test_save_and_load(spark, tmp_path):
    import datetime as dt

    groups = spark.createDataFrame([("a", "a"), ("b", "a")], "productName string, group_id string")
    reps = spark.createDataFrame([("a", "b", 2)], "group_id string, representative string, group_size bigint")
    similarity.save_groups(str(tmp_path / "m"), groups, reps, 0.7, dt.date(2024, 1, 1))
    loaded, _, settings = similarity.load_groups(spark, str(tmp_path / "m"))
    assert loaded.count() == 2 and settings.first()["product_count"] == 2


def test_grid_join_meets_every_pair_once(spark):
    left = spark.range(60).select(F.col("id").alias("a"), (F.col("id") % 2 == 0).cast("int").alias("k"))
    right = spark.range(45).select(F.col("id").alias("b"), F.when(F.col("id") < 40, 1).otherwise(0).alias("k"))
    got = grid_join(left, right, "k", "a", "b", F.lit(True), block_sizes(left, right, "k", 4)).collect()
    assert sorted((r["a"], r["b"]) for r in got) == sorted(
        (a, b) for a in range(60) for b in range(45) if int(a % 2 == 0) == int(b < 40))


def plain_leaders(items, similar):
    leaders, cluster = [], {}
    for x in items:
        home = next((l for l in leaders if similar(l, x)), None)
        if home is None:
            leaders.append(x)
        cluster[x] = x if home is None else home
    return cluster


def plain_ratio(a, b):
    a, b = (" ".join(sorted(t.split())) for t in (a, b))
    row = [0] * (len(b) + 1)
    for ch in a:
        last = 0
        for j, other in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if ch == other else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b)) if a or b else 100.0


@pytest.mark.parametrize("threshold, block", [(90, 2000), (80, 5)])
def test_fuzzy_clusters(spark, threshold, block):
    rng = random.Random(5)
    names = set()
    for n in make_names(25, seed=4):
        names.add(n)
        for _ in range(3):
            i = rng.randrange(len(n))
            names.add((n[:i] + rng.choice(["", "x", n[i] * 2]) + n[i + 1:]).strip())
    names = sorted(x for x in names if x)
    got = {r["clean_name"]: r["cluster"] for r in clusters.fuzzy_name_clusters(frame(spark, names), threshold, rows_per_block=block).collect()}
    clean = sorted({re.sub("-", " ", n.lower()).strip() for n in names})
    assert got == plain_leaders(clean, lambda a, b: plain_ratio(a, b) >= threshold)


def test_fuzzy_order_column(spark):
    df = spark.createDataFrame([("abcdefghij", "2024-01-02"), ("abcdefghix", "2024-01-01")], "productName string, seen string")
    got = {r["cluster"] for r in clusters.fuzzy_name_clusters(df, order_col="seen").collect()}
    assert got == {"abcdefghix"}


@pytest.mark.parametrize("threshold, block", [(0.9, 2000), (0.5, 35), (0.2, 50)])
def test_embedding_clusters(spark, threshold, block):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), [float(x) for x in centres[i % 6] + 0.25 * rng.normal(size=8)]) for i in range(120)]
    rows += [(200 + i, rows[5][1]) for i in range(40)] + [(300, [0.0] * 8), (301, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(6)
    got = {r["id"]: r["cluster"] for r in clusters.embedding_clusters(df, threshold, rows_per_block=block).collect()}
    unit = {i: np.float32(v) / (np.linalg.norm(np.float32(v)) or 1) for i, v in rows}
    want = plain_leaders(sorted(unit), lambda a, b: float(unit[a] @ unit[b]) >= threshold)
    want[301] = 300  # equal vectors share a cluster, also empty ones
    assert got == want


def test_rollup_modes(spark):
    lines = spark.createDataFrame([
        ("a", 1.0, 1.0, "B2", None), ("a", 1.0, 1.0, "B1", None), ("b", 1.0, 1.0, "B1", None), ("b", 1.0, 1.0, "B2", None)],
        "productName string, totalProductPrice double, quantity double, brandName string, categoryName string")
    mapping = spark.createDataFrame([("a", "k"), ("b", "k")], "productName string, cluster string")
    r = clusters.cluster_rollup(lines, mapping).first()
    assert (r["product_name"], r["brand"], r["category"], r["total_sales"], r["quantity_sold"]) == ("a", "B1", "", 4.0, 4)


def test_fuzzy_keys_grow_with_the_length_of_a_text(spark):
    rng = random.Random(5)
    texts = [(n, "".join(rng.choice("abcdefgh ij") for _ in range(n))) for n in (1, 4, 20, 80, 160, 300)]
    frame_of = spark.createDataFrame(texts, "id long, text string").withColumn("len", F.length("text"))
    keys = {r["id"]: r["n"] for r in clusters.gram_keys(frame_of, 90).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert set(keys) == {n for n, _ in texts} and all(n <= 0.4 * size + 1 for size, n in keys.items())


@pytest.mark.parametrize("threshold", [70, 80, 90, 96])
def test_similar_texts_lose_no_pair(spark, threshold):
    """Inserts, deletes and changed letters at all places, in short and long texts, against every pair."""
    rng = random.Random(threshold)
    texts = {"", "a", "b", "ab", "ba", "aaaa", "aaaaa", "aaaaaa"}
    for size in (5, 9, 14, 30, 90):
        for _ in range(6):
            text = "".join(rng.choice("abc d") for _ in range(size))
            texts.add(text)
            for _ in range(4):
                text = list(text)
                for _ in range(rng.randint(1, 1 + size // 12)):
                    at = rng.randrange(len(text))
                    text[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "a", "b"])
                text = "".join(text) or "z"
                texts.add(text)
    rows = list(enumerate(sorted(texts)))

    def ratio(x, y):
        before = [0] * (len(y) + 1)
        for ch in x:
            now = [0]
            for j, other in enumerate(y):
                now.append(before[j] + 1 if ch == other else max(before[j + 1], now[j]))
            before = now
        return 200.0 * before[-1] / (len(x) + len(y))

    want = {(i, j) for i, x in rows for j, y in rows if i < j and x and y and ratio(x, y) >= threshold}
    frame_of = spark.createDataFrame(rows, "id long, text string").withColumn("len", F.length("text"))
    assert {tuple(r) for r in clusters.similar_texts(frame_of, threshold, rows_per_block=9).collect()} == want


def test_vectors_visit_few_cells(spark):
    """On clustered vectors less than a fifth of the pairs of vector and cell are opened, and no similar vector is lost."""
    rng = np.random.default_rng(9)
    heads = rng.normal(size=(30, 16))
    x = heads[np.arange(900) % 30] + rng.normal(scale=0.05, size=(900, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] = 0
    units = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(4)
    rows = clusters.vector_cells(units, 0.95, "bigint", per_cell=30).collect()
    cell, visits = {r["id"]: r["cell"] for r in rows}, {r["id"]: set(r["visits"]) for r in rows}
    assert len(rows) == 900 and cell[7] == -1 and not visits[7] and len(set(cell.values())) == 31
    assert sum(map(len, visits.values())) < 0.2 * 900 * 30
    near = np.argwhere(x @ x.T >= 0.95)
    assert all(cell[i] in visits[j] for i, j in near.tolist())


@pytest.mark.parametrize("per_cell, block", [(1000, 10_000), (9, 4), (3, 10_000)])
def test_embedding_clusters_by_cells(spark, per_cell, block):
    rng = np.random.default_rng(4)
    heads = rng.normal(size=(9, 5))
    rows = [(i, (heads[i % 9] + rng.normal(scale=(0.05, 0.4)[i % 2], size=5)).tolist()) for i in range(150)] + [(200, [0.0] * 5), (201, [0.0] * 5)]
    rows += [(300 + i, rows[i][1]) for i in range(5)]
    unit = np.array([np.array(v) / (np.linalg.norm(v) or 1) for _, v in rows])
    leaders, want = [], {}
    for k, (i, v) in enumerate(rows):
        same = [j for j in range(k) if rows[j][1] == v]
        lead = next((j for j in leaders if unit[k] @ unit[j] >= 0.9 - 1e-9), None)
        want[i] = want[rows[same[0]][0]] if same else i if lead is None else rows[lead][0]
        if not same and lead is None:
            leaders.append(k)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = clusters.embedding_clusters(vectors, 0.9, rows_per_block=block, per_cell=per_cell)
    assert dict(map(tuple, found.collect())) == want


@pytest.mark.parametrize("threshold", [0.9, 0.35])
def test_vectors_without_clustering_are_stored_a_few_times_only(spark, threshold):
    """Most cells are open to vectors without any clustering; what is stored must not grow with the number of cells."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 64)).astype(np.float32)
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    stored = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    before = stored()
    got = {r["id"]: r["cluster"] for r in clusters.embedding_clusters(vectors, threshold, rows_per_block=700, per_cell=2).collect()}
    assert stored() - before < 4 * x.nbytes
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    assert got == plain_leaders(range(2000), lambda a, b: near[a, b])


def test_thresholds_share_one_forest(spark, sample):
    names, vectors = sample
    thresholds = [0.7, 0.4, 0.9, 0.5]
    rows = {r["threshold"]: r for r in similarity.compare_thresholds(frame(spark, names), thresholds, []).collect()}
    assert list(rows) == thresholds
    for t, r in rows.items():
        sizes = Counter(plain_groups(names, vectors, t).values()).values()
        assert (r["total_groups"], r["multi_product_groups"], r["single_product_groups"]) == (
            len(sizes), sum(n > 1 for n in sizes), sum(n == 1 for n in sizes))


def test_forest_keeps_the_groups_of_every_threshold(spark, monkeypatch):
    rng = random.Random(7)
    nodes = [f"n{i:03d}" for i in range(120)]
    pairs = [(*sorted(rng.sample(nodes, 2)), round(rng.random(), 2)) for _ in range(3000)]
    monkeypatch.setattr(similarity, "FOREST_NODES", 160)
    table = spark.createDataFrame(pairs, "vec_a string, vec_b string, similarity double").repartition(5)
    kept = [tuple(r) for r in similarity.strongest_forest(table).collect()]
    assert set(kept) <= set(pairs) and len(kept) <= 5 * len(nodes)

    def groups(edges, t):
        label = {n: n for n in nodes}
        for a, b, w in edges:
            if w >= t and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {n: low if v == high else v for n, v in label.items()}
        return label

    assert all(groups(kept, t) == groups(pairs, t) for t in (0.0, 0.5, 0.9, 0.95, 0.99, 1.0))


@pytest.mark.parametrize("threshold", [0.3, 0.6])
def test_new_names_meet_stored_representatives(spark, sample, tmp_path, threshold):
    names, vectors = sample
    df, path = frame(spark, names), str(tmp_path / "model")
    groups, representatives = similarity.fit_groups(df, 0.7, [])
    similarity.save_model(path, df, groups, representatives, 0.7, None, [])
    tokens = {n: Counter(" ".join(t[i:i + k]) for k in (1, 2, 3) for t in [re.findall(r"[a-zA-Z]{2,}", plain_text(n))] for i in range(len(t) - k + 1)) for n in names}
    df_of = Counter(t for c in tokens.values() for t in c)
    kept = {t for v in vectors.values() for t in v}
    new = ["choco bar supreme", "dark milk", "never heard", "LEMON lime 7ml", "salt", ""]
    want = {}
    for name in new:
        words = re.findall(r"[a-zA-Z]{2,}", plain_text(name.lower()))
        grams = Counter(" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
        raw = {t: n * (math.log((1 + len(names)) / (1 + df_of[t])) + 1) for t, n in grams.items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        scored = [(-round(cosine({t: w / norm for t, w in raw.items()}, vectors[r["representative"]]), 6), r["representative"])
                  for r in representatives.collect()] if norm else []
        scored = sorted(x for x in scored if -x[0] >= threshold)
        want[name] = (scored[0][1], -scored[0][0]) if scored else (None, None)
    found = similarity.score_names(spark, path, frame(spark, new), threshold).collect()
    assert {r["productName"]: (r["representative"], r["similarity"]) for r in found} == want
    assert any(v[0] for v in want.values()) and want["never heard"] == (None, None)
