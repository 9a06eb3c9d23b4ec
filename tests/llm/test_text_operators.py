"""The operators on whole texts beside plain brute force, on awkward rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from basketry.llm import decontamination, language_crf, packing, prefix_free, repeats, simhash, super_kmers, token_scan
from basketry.llm.common import table
from basketry.llm.tokens import encoder, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def repeats_of(rows, length):
    data = [(t or "").encode() for _, t in rows]
    counts = Counter(d[p:p + length] for d in data for p in range(len(d) - length + 1))
    for (i, _), d in zip(rows, data):
        covered = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            if counts[d[p:p + length]] > 1:
                covered[p:p + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        yield i, len(d), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [24, 60, 400])
def test_prefix_free_parsing(awkward, make_docs, length):
    found = prefix_free.find_repeats(make_docs(awkward), length=length)
    assert Counter(map(tuple, found.collect())) == Counter(repeats_of(awkward, length))


def test_removed_bytes_leave_columns_and_clean_texts(awkward, make_docs):
    docs = make_docs(awkward)
    kept = prefix_free.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(awkward)
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[1] is None and texts[13] == dict(awkward)[13] and texts[11] == "" and texts[6] == ""


def repeated_words_of(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    place = lambda i: 1 << 62 if i is None else i
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, 1 << 63), place(i))
    for i, w in words:
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < place(i) for q in range(p, p + window)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        yield i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("window,bucket", [(13, 1000), (13, 1), (3, 1000), (1, 1000)])
def test_super_kmers(awkward, make_docs, window, bucket, monkeypatch):
    monkeypatch.setattr(repeats, "KINDS_PER_BUCKET", bucket)
    found = super_kmers.find_repeated_words(make_docs(awkward), window=window)
    assert Counter(map(tuple, found.collect())) == Counter(repeated_words_of(awkward, window))


def test_first_of_equal_minimisers_for_any_length(monkeypatch):
    code = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64) >> np.uint64(41) << np.uint64(41)
    near = super_kmers._first_least(code, 11)
    monkeypatch.setattr(super_kmers, "_PLACE_BITS", 8)
    assert (super_kmers._first_least(code, 11) == near).all()


def test_wu_manber(awkward, make_docs, spark):
    base = dict(awkward)[6]
    items = [(1, base[100:260]), (1, "W7 w8"), (2, "one"), (3, None), (4, ""), (5, "..."), (None, "w1"), (6, dict(awkward)[13][:5000]), (7, "Δelta zeta9")]
    source = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = PLAIN.findall((t or "").translate(LOWER))
        for p in range(max(1, len(w) - 9) if w else 0):
            if i is not None:
                windows[tuple(w[p:p + 10])].add(str(i))
    want = Counter()
    for i, t in awkward:
        w = PLAIN.findall((t or "").translate(LOWER))
        hit, names = set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in windows:
                    hit |= set(range(p, p + k))
                    names |= windows[tuple(w[p:p + k])]
        want[i, len(w), len(hit), tuple(sorted(names))] += 1
    for block_bytes in (decontamination.PATTERN_BYTES_PER_BLOCK, 20_000):
        rows = decontamination.find_contamination(make_docs(awkward), source, block_bytes=block_bytes).collect()
        assert Counter((r["doc_id"], r["n_words"], sum(r["lengths"]), tuple(r["items"])) for r in rows) == want
    clean = decontamination.drop_contaminated(make_docs(awkward), source)
    assert clean.columns == make_docs(awkward).columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(k[0] for k in want.elements() if not k[3])
    none = decontamination.find_contamination(make_docs(awkward), source.where("false"))
    assert none.where("size(items) > 0").count() == 0 and none.count() == len(awkward)


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    label = list(range(n))
    for a, b in links:
        x, y = label[a], label[b]
        label = [min(x, y) if v in (x, y) else v for v in label]
    return label


@pytest.mark.parametrize("rows_per_block", [2048, 4])
def test_simhash(awkward, make_docs, rows_per_block, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (simhash.MAX_DISTANCE, rows_per_block))
    marks = [plain_fingerprint(t) for _, t in awkward]
    label = roots(len(marks), [(i, j) for i in range(len(marks)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4])
    least = defaultdict(list)
    for k, (i, _) in zip(label, awkward):
        least[k].append(i)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    rows = simhash.near_duplicate_groups(make_docs(awkward)).collect()
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component"]) for r in rows) == Counter(
        (i, m, least[k]) for (i, _), m, k in zip(awkward, marks, label))
    kept = simhash.drop_near_duplicates(make_docs(awkward))
    assert kept.columns == make_docs(awkward).columns and kept.count() == len(set(label))


def test_covering_triples():
    from itertools import combinations

    chosen = simhash.covering_triples()
    assert all(any(set(t) <= set(q) for t in chosen) for q in combinations(range(8), 4))


def test_packing(awkward, make_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack_documents(make_docs(awkward), keep_ids=True).collect()
    want, places = Counter(), defaultdict(list)
    for i, t in awkward:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            want[i, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(places) == -(-sum(r["length"] for r in rows) // 4096)


def test_capitals_with_marks_are_composed_before_they_are_lowered():
    from tokenizers import Tokenizer

    tokenizer, encode = Tokenizer.from_file(tokenizer_path()), encoder(tokenizer_path())
    pairs = ["H\u0331", "J\u030C", "T\u0308", "W\u030A", "Y\u030A"]
    for text in [*pairs, " ".join(pairs), f"Plain WORDS before\t{' Mixed '.join(pairs)} and AFTER", "ÀÉ Straße İI " + pairs[0].lower()]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_plan_places_all_and_fills_gaps():
    assert packing.plan_patterns({4000: 5, 96: 2, 50: 2, 46: 2, 30: 1, 33: 2}) and len(packing.plan_patterns({})) == 0
    counts = Counter(np.random.default_rng(5).integers(1, 4097, 5000).tolist()) + Counter({1365: 3000})
    plan = packing.plan_patterns(counts)
    placed = Counter()
    for pattern, times in plan:
        assert sum(n * k for n, k in pattern) <= 4096
        for n, k in pattern:
            placed[n] += k * times
    assert placed == counts
    exact = packing.plan_patterns({3000: 1, 600: 1, 400: 1, 96: 1, 700: 1})
    assert (((3000, 1), (600, 1), (400, 1), (96, 1)), 1) in exact


def test_separator_scan(awkward, make_docs, tmp_path, spark):
    encode = encoder(tokenizer_path(), True)
    rows = token_scan.document_token_counts(make_docs(awkward), block_tokens=37).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == Counter((i, len(encode(t)) // 4) for i, t in awkward)
    ids = np.random.default_rng(2).integers(0, 5, 5000).astype("<u2")
    ids.tofile(tmp_path / "a.bin")
    np.array([4, 4, 1], "<u2").tofile(tmp_path / "b.bin")
    np.array([], "<u2").tofile(tmp_path / "c.bin")
    found = token_scan.count_tokens(token_scan.read_flat(spark, str(tmp_path), block_tokens=64), end_id=4, blocks_per_run=3).collect()
    by_file = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["file_id"], r["doc_index"])):
        by_file[r["file_id"][-5:]].append((r["start"], r["n_tokens"], r["closed"]))
    def plain(values):
        start, out = 0, []
        for p in np.flatnonzero(values == 4).tolist():
            out.append((start, p - start, True))
            start = p + 1
        return out + [(start, len(values) - start, False)] * (start < len(values))
    assert by_file["a.bin"] == plain(ids) and by_file["b.bin"] == [(0, 0, True), (1, 0, True), (2, 1, False)] and "c.bin" not in by_file


def test_language_of_held_out_and_mixed_texts(spark, sf_dir, make_docs):
    docs = table(spark, sf_dir, "documents")
    model = language_crf.fit_on(docs)
    rows = language_crf.label_languages(docs, model).withColumn("held_out", language_crf.held_out()).collect()
    known = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in known) >= 0.95 * len(known) and len(known) > 20
    odd = language_crf.label_languages(make_docs([(1, None), (2, ""), (3, "12 ..."), (None, "the"), (4, "the " * 3000)]), model)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in odd.collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] != "und" and 0 < got[4][1] <= 1
    assert language_crf.keep_identified(make_docs([(1, None), (4, "the and of")]), model).count() == 1
    unlearned = language_crf.label_languages(make_docs([(1, "the")]), language_crf.fit([], []))
    assert unlearned.first()["lang_pred"] == "und"


def test_clear_texts_of_three_languages_stay(make_docs):
    said = {"de": "wolke regen sturm", "fr": "pluie nuage vent", "es": "lluvia nube viento"}
    model = language_crf.fit([t for t in said.values() for _ in range(40)], [y for y in said for _ in range(40)])
    docs = make_docs([(1, " ".join(f"{t} " * 20 for t in said.values())), (2, "12 ..."), (3, None)])
    assert language_crf.label_languages(docs, model).where("doc_id = 1").first()["score"] < 0.4
    assert [r["doc_id"] for r in language_crf.keep_identified(docs, model).collect()] == [1]


def test_every_letter_of_a_long_run_counts():
    model = language_crf.fit(["wolke regen sturm"] * 40 + ["pluie nuage vent"] * 40, ["de"] * 40 + ["fr"] * 40)
    inner = "pluienuagevent" * 700
    text = "wolkeregensturm" * 3 + inner + "wolkeregensturm" * 3
    pieces = language_crf.words_of(text)
    assert "".join(pieces) == text and max(map(len, pieces)) == 64 and len(pieces) == -(-len(text) // 64)
    assert language_crf.words_of("\u96e8" * 130 + " ab") == ["\u96e8" * 64, "\u96e8" * 64, "\u96e8" * 2, "ab"]
    means = language_crf.Labeller(model)([text, inner, inner + " wolke"])
    assert (means.argmax(1) == model.labels.index("fr")).all() and means[2].max() > 0.9


def test_lanes_give_the_plain_forward_backward():
    rng = np.random.default_rng(0)
    sizes, step = np.array([0, 1, 5, 17, 16, 0, 40, 8]), rng.random((3, 3)) + 0.1
    psi = rng.random((sizes.sum(), 3)) + 0.01
    means, at = language_crf.lane_means(psi, sizes, step, 8), 0
    for k, n in enumerate(sizes):
        if n:
            gamma, _ = language_crf.forward_backward(psi[at:at + n][None], step)
            assert np.allclose(gamma[0].mean(0), means[k])
        at += n


def test_forward_backward_against_all_label_sequences():
    """Label probabilities and transitions are sums over every label sequence, and the slopes of the log of their total."""
    rng = np.random.default_rng(2)
    score, move = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))

    def total(score, move):
        return np.log(sum(np.exp(sum(score[t, y] for t, y in enumerate(s)) + sum(move[a, b] for a, b in zip(s, s[1:])))
                          for s in itertools.product(range(3), repeat=4)))

    gamma, pairs = language_crf.forward_backward(np.exp(score)[None], np.exp(move))
    weight = {s: np.exp(sum(score[t, y] for t, y in enumerate(s)) + sum(move[a, b] for a, b in zip(s, s[1:])) - total(score, move))
              for s in itertools.product(range(3), repeat=4)}
    for t, y in np.ndindex(4, 3):
        nudge = np.zeros((4, 3))
        nudge[t, y] = 1e-5
        assert np.isclose(gamma[0, t, y], sum(w for s, w in weight.items() if s[t] == y))
        assert np.isclose(gamma[0, t, y], (total(score + nudge, move) - total(score - nudge, move)) / 2e-5, atol=1e-7)
    for a, b in np.ndindex(3, 3):
        nudge = np.zeros((3, 3))
        nudge[a, b] = 1e-5
        assert np.isclose(pairs[a, b], (total(score, move + nudge) - total(score, move - nudge)) / 2e-5, atol=1e-7)


def test_training_rows_of_a_frequent_label(spark, make_docs):
    """Each language gets at most its share of rows; parts are cut on the map side, before any shuffle."""
    rows = [(i, f"text {i} " * 3, "en" if i % 3 else "de") for i in range(3000)] + [(1, "same", "fr")] * 90 + [(5, None, "es"), (None, "x", "it")]
    docs = make_docs(rows).repartition(6)
    sample = language_crf.training_rows(docs, "doc_id", "text", "lang", per_language=60)
    counts = Counter(r["label"] for r in sample.collect())
    assert counts["en"] == counts["de"] == 60 and 0 < counts["fr"] <= 60 and set(counts) == {"en", "de", "fr"}
    again = language_crf.training_rows(docs.repartition(3), "doc_id", "text", "lang", per_language=60)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, sample.collect()))
    assert sample._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("WindowGroupLimit") == 4
    few = language_crf.training_rows(docs, "doc_id", "text", "lang", per_language=2).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in few} == {"en": 2, "de": 2, "fr": 1}


def test_empty_tables(make_docs, spark):
    docs = make_docs([])
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (prefix_free.find_repeats(docs), super_kmers.find_repeated_words(docs), decontamination.find_contamination(docs, items),
               simhash.near_duplicate_groups(docs), packing.pack_documents(docs), token_scan.document_token_counts(docs),
               language_crf.label_languages(docs, language_crf.fit_on(docs))):
        assert df.count() == 0
