"""Class n-grams, the Merkle manifest and the centroid clustering against plain computations."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import catalog, centroids, class_ngrams, merkle
from basketry.llm.common import table


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def plain_path(levels, at):
    for nodes in levels[:-1]:
        run = at - at % 8
        yield "".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])
        at //= 8


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def lower_ascii(text):
    return None if text is None else "".join(c.lower() if c < "\x80" else c for c in text)


def plain_manifest(rows, tampered):
    """Rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, H(*map(value, r)))):
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [plain_tree([H(*map(value, r)) for r in groups[g]]) for g in langs]
    top = plain_tree([t[-1][0] for t in trees])
    for k, (g, tree) in enumerate(zip(langs, trees)):
        for i, r in enumerate(groups[g]):
            path, node = [*plain_path(tree, i), *plain_path(top, k)], tree[0][i]
            if tampered(r[0]):
                node = H(*map(value, (*r[:4], lower_ascii(r[4]))))
            for before, after in path:
                node = H(before, node, after)
            yield r[0], tree[0][i], tree[-1][0], top[-1][0], H(*[x for s in path for x in s]), node, node == top[-1][0]


def third(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 0


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(spark, levels):
    rows = [(i, "S", ["en", "de", "é", "z"][min(i % 7, 3)], i, f"Text {i} É") for i in range(150)]
    rows += [(i, None, None, None, None) for i in (500, 501)] + [(502, "s", "one", 3, ""), (None, "s", "one", 3, "A"), (7, "S", "en", 7, "Other"),
             (8, "S", "en", 8, "Text 8 É"), (9, "", "", 0, "B" * 5000)] + [(1000 + i, "s", "nine", 1, "x") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns(
        {c: F.lit("x") for c in ("tree", "pos", "digest", "id", "row", "depth", "path")})
    condition = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = merkle.manifest(docs, levels=levels, tampered=condition)
    assert Counter(map(tuple, found.collect())) == Counter(plain_manifest(rows, third))
    assert merkle.manifest(docs.where("false")).count() == 0
    single = merkle.manifest(docs.where("doc_id = 502"), levels=levels).collect()[0]
    assert single["leaf"] == single["root"] == single["subroot"] and single["proof_sha256"] == H("") and not single["verified"] == third(502)


def test_manifest_of_more_levels_than_stored(spark):
    rows = [(i, None, "a", None, str(i)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert set(map(tuple, merkle.manifest(docs).collect())) == set(plain_manifest(rows, lambda i: False))


def plain_clusters(rows, clusters, rounds, dimensions):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[:clusters]]
    for turn in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres] for _, v in kept]
        own = [min(range(len(centres)), key=lambda k: (d[k], k)) for d in far]
        if turn < rounds:
            for k in range(len(centres)):
                members = [v for (_, v), o in zip(kept, own) if o == k]
                if members:
                    centres[k] = [sum(x) // len(members) for x in zip(*members)]
    sums = Counter()
    for d, o in zip(far, own) if kept else ():
        sums[o] += d[o]
    return Counter((i, o, d[o], sums[o], sum(sums.values()), hashlib.sha256(",".join(map(str, centres[o])).encode()).hexdigest())
                   for (i, _), d, o in zip(kept, far, own)) if kept else Counter()


def test_clusters(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) + 3 * (i % 4)).tolist()) for i in range(90)]
    rows += [(200, None), (201, [1.0] * 5), (202, [float("nan")] + [1.0] * 5), (203, [None] + [1.0] * 5), (204, [float("-inf")] + [1.0] * 5), (205, []),
             (206, [0.0] * 6), (206, [0.0] * 6), (206, [-0.001] * 6), (None, [2.0] * 6), (None, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "v", "cluster", "pivots", "distance")})
    for clusters, rounds, pivots in ((7, 5, 3), (40, 2, 8), (200, 1, 1)):
        found = centroids.cluster_vectors(vectors, clusters=clusters, rounds=rounds, pivots=pivots, dimensions=6)
        assert Counter(map(tuple, found.collect())) == plain_clusters(rows, clusters, rounds, 6)
    assert centroids.cluster_vectors(vectors.where("false"), dimensions=6).count() == 0
    with pytest.raises(Exception, match="a component is beyond"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9] * 6)], "vec_id long, embedding array<double>"), dimensions=6).collect()


def test_pivots_rule_out_centroids():
    rng = np.random.default_rng(3)
    centres = (rng.normal(size=(40, 64)) * 2000).astype(np.int64)
    x = centres[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 64))
    pivots = centroids.choose_pivots(centres, 8)
    cluster, distance, exact = centroids.nearest(x, centroids.pivot_distances(x, pivots), centres, centroids.pivot_distances(centres, pivots))
    far = np.stack([centroids.squared(x, c) for c in centres], 1)
    assert (cluster == far.argmin(1)).all() and (distance == far.min(1)).all()
    assert exact < 0.2 * far.size


def tokens_of(text):
    return (text or "").encode().lower().split() + [b" "]


def test_class_model_scores(spark, awkward, make_docs, monkeypatch):
    """Base scores by plain counting; the model's score from its own classes, word by word; probabilities sum to one."""
    monkeypatch.setattr(class_ngrams, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(class_ngrams, "WORDS_AT_ONCE", 300)
    docs = make_docs(awkward)
    fifth = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    got = class_ngrams.score_texts(docs, held_out=fifth, classes=8, seeds=20).collect()
    counts = Counter(t for i, text, *_ in awkward if not held(i) for t in tokens_of(text))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, text, *_ in awkward:
        own = tokens_of(text)
        base = sum(math.log10((counts.get(t, 0) + 0.5) / (total + 0.5 * (kinds + 1))) for t in own)
        want[i, held(i), len(own), sum(t in counts for t in own), total, round(base, 6)] += 1
    assert Counter((*r[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)

    source = docs.select(F.col("doc_id").alias("id"), "text", F.coalesce(fifth, F.lit(False)).alias("held"))
    fitted = class_ngrams.Fitted(source, 8, 20)
    words, model = {}, fitted.model
    for block in fitted.blocks.join(fitted.classed.groupBy("block").agg(F.collect_list(F.struct("part", "cls")).alias("classed")), "block", "left").collect():
        learned = {c["part"]: c for c in block["counted"] or ()}
        for chunk in block["classed"] or ():
            assert len(chunk["cls"]) * 4 == len(learned[chunk["part"]]["rank"])
            words.setdefault(chunk["part"], {}).update(zip(np.frombuffer(learned[chunk["part"]]["rank"], np.int32).tolist(), zip(
                chunk["cls"], np.frombuffer(learned[chunk["part"]]["known"], np.int64).tolist())))
    emitted = Counter()
    for part in words.values():
        for cls, known in part.values():
            assert cls < 8
            emitted[cls] += known
    assert sum(map(len, words.values())) == kinds - 1 and fitted.kinds == kinds
    # The words of a class make up its count, so their shares sum to one.
    assert all(emitted[c] == model.class_counts[c] for c in range(8)) and model.class_counts[8] == counts[b" "]
    follow = (10 ** model.log_class[:, :, :9]).sum(2)
    assert np.allclose(follow, 1) and np.allclose(10 ** model.log_new + 10 ** model.log_old, 1)


def test_class_model_token_by_token():
    rng = np.random.default_rng(2)
    classes, width = 3, 5
    cls = rng.integers(0, 3, 400)
    cls[rng.random(400) < 0.1] = 3
    cls[-1] = 3
    one = np.concatenate(([3], cls[:-1]))
    two = np.where(one == 3, 3, np.concatenate(([3], one[:-1])))
    triples = np.zeros((width,) * 3, np.int64)
    np.add.at(triples, (two, one, cls), 1)
    once_after = np.bincount(one[:20], minlength=width)
    model = class_ngrams.Model(triples, once_after)
    n1, n2, n3 = Counter(cls.tolist()), Counter(zip(one.tolist(), cls.tolist())), Counter(zip(two.tolist(), one.tolist(), cls.tolist()))

    def smoothed(counts, context, c, lower):
        after = {k[-1]: v for k, v in counts.items() if k[:-1] == context}
        return (after.get(c, 0) + len(after) * lower) / (sum(after.values()) + len(after)) if after else lower

    text, known = np.array([0, 4, 1, 2, 3, 2, 2, 4, 4, 3]), np.array([5, 0, 7, 3, 30, 2, 2, 0, 0, 30])
    want, a, b = [], 3, 3
    for c, k in zip(text.tolist(), known.tolist()):
        rate = (once_after.sum() + 0.5) / 401
        new = (once_after[b] + rate) / (sum(v for (x, _), v in n2.items() if x == b) + 1)
        p = new if c == 4 else (1 - new) * smoothed(n3, (a, b), c, smoothed(n2, (b,), c, n1[c] / 400)) * k / n1[c]
        want.append(math.log10(p))
        a, b = (3 if c == 3 else b), c
        if b == 3:
            a = 3
    assert np.allclose(model.token_scores(text, known), want)


def test_gains_are_those_of_the_objective():
    """Moving a word changes the sum of x log x over class pairs, less those of the classes, as the gains say."""
    rng = np.random.default_rng(6)
    pairs = rng.integers(0, 4, (12, 12)) * (rng.random((12, 12)) < 0.5)
    np.fill_diagonal(pairs, 0)
    own = np.concatenate(([3], rng.integers(0, 3, 11)))
    f = lambda x: (x * np.log(np.maximum(x, 1))).sum()

    def objective(own):
        totals = np.zeros((5, 5))
        np.add.at(totals, (own[:, None], own[None, :]), pairs)
        return totals, f(totals) - f(totals.sum(1)) - f(totals.sum(0))

    totals, now = objective(own)
    for w in range(1, 12):
        after, before = np.bincount(own, pairs[w], 5), np.bincount(own, pairs[:, w], 5)
        key = np.concatenate((np.flatnonzero(after), 5 + np.flatnonzero(before)))
        n = np.concatenate((after[after > 0], before[before > 0])).astype(np.int64)
        gains = class_ngrams.ClassGains(totals)(np.zeros(len(key), np.int64), key, n, own[w:w + 1])[0]
        for k in range(3):
            moved = own.copy()
            moved[w] = k
            # Exact where the word's neighbours lie outside both classes.
            if not ({own[w], k} & set(np.flatnonzero(after + before).tolist())):
                assert abs(gains[k] - gains[own[w]] - (objective(moved)[1] - now)) < 1e-9


def test_exchange_finds_the_classes_of_a_grammar():
    """Words of two kinds that take turns end in classes of their own kind."""
    pairs = np.zeros((21, 21), np.int64)
    rng = np.random.default_rng(1)
    for _ in range(4000):
        pairs[1 + rng.integers(0, 10), 11 + rng.integers(0, 10)] += 1
        pairs[11 + rng.integers(0, 10), 1 + rng.integers(0, 10)] += 1
    own = class_ngrams.exchange(pairs, 2, 6)
    assert len(set(own[:10])) == len(set(own[10:])) == 1 and own[0] != own[10]


def test_held_out_texts_score_better_than_by_single_words(spark, sf_dir):
    rows = catalog.queries()["op11_brown_classes"](spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert rows[2] > 10 and rows[0] > rows[1]
    assert table(spark, sf_dir, "documents").count() == catalog.queries()["op11_brown_classes"](spark, sf_dir).count()


def test_class_model_without_training_rows_or_rows(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    got = class_ngrams.score_texts(docs, held_out=F.lit(True)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)}
    assert class_ngrams.score_texts(docs.where("false")).count() == 0
