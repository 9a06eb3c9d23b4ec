"""Language identification by a linear-chain conditional random field over words.

Every word has a label. Affixes, character n-grams and the word itself, where the training words list it in the
lexicon, score the labels of a word; learned transitions score the labels of neighbours. Forward-backward gives
the label probabilities of each word, also where a text changes its language, and their mean decides for a text.
"""

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from basketry.llm.common import map_batches

UNDETERMINED = "und"
TRAIN_ROWS_PER_LANGUAGE = 1500
TRAIN_CHARS = 500
SAMPLE_PARTS = 15
SAMPLE_CHUNKS = 64
FEATURE_BITS = 17
SEQUENCE = 48
ROUNDS = 50
LANE = 512
DOCS_AT_ONCE = 2000
CHARS_AT_ONCE = 2_000_000
WORDS_KEPT = 150_000
LONGEST_WORD = 64

_ALL_BITS = (1 << 64) - 1
_WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST_WORD}}}")


def words_of(text) -> list:
    """Runs of letters of a text, in lower case; none if it only has signs such as superscript figures. A run of
    more than 64 letters, as in scripts without spaces, gives consecutive words of at most 64."""
    words = _WORD.findall(text.lower()) if text else []
    return words if any(c.isalpha() for w in words for c in w) else []


def _slots(kind: int, *codes) -> np.ndarray:
    """Feature numbers of tuples of code points, hashed together with their kind."""
    mixed = np.full(len(codes[0]), kind * 0x9E3779B97F4A7C15 & _ALL_BITS, np.uint64)
    for c in codes:
        mixed = (mixed ^ c) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
    return (mixed & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)


def word_features(words: list, lexicon) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word number) of all hashed affix, n-gram and lexicon features, ordered by word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = [f"^{w}$" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    stops = np.cumsum(sizes)
    first, letters, number = stops - sizes + 1, sizes - 2, np.arange(len(words))
    # An n-gram starts at every place of a marked word but its last two.
    starts = np.arange(len(codes) - 2)
    in_word = np.ones(len(codes), bool)
    in_word[stops - 1] = in_word[stops - 2] = False
    starts = starts[in_word[:-2]]
    found = [(_slots(0, codes[starts], codes[starts + 1], codes[starts + 2]), np.repeat(number, letters))]
    for k in (1, 2, 3, 4):
        has = letters >= k
        if k < 4:
            found.append((_slots(k, *[codes[first[has] + i] for i in range(k)]), number[has]))
        found.append((_slots(8 + k, *[codes[stops[has] - 2 - i] for i in range(k)]), number[has]))
    listed = [i for i, w in enumerate(words) if w in lexicon]
    whole = np.array([zlib.crc32(words[i].encode("utf-8", "surrogatepass")) for i in listed], np.uint64)
    found.append((_slots(16, whole), np.array(listed, np.int64)))
    features, owner = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(owner, kind="stable")
    return features[order], owner[order]


def sums_by(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows in groups of these sizes, none of which is empty."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0) if len(sizes) else np.zeros((0, values.shape[1]))


def forward_backward(psi: np.ndarray, step: np.ndarray):
    """For equally long sequences, psi (n, t, labels): label probabilities (n, t, labels) and the expected
    transitions (labels, labels) of all. ``step`` holds the transition potentials; every first label is alike."""
    n, length, k = psi.shape
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    at = np.ones((n, k))
    for t in range(length):
        at = (at @ step if t else at) * psi[:, t]
        at /= at.sum(1, keepdims=True)
        alpha[:, t] = at
    pairs, back = np.zeros((k, k)), np.ones((n, k))
    for t in range(length - 1, 0, -1):
        beta[:, t] = back
        ahead = psi[:, t] * back
        both = alpha[:, t - 1, :, None] * step[None] * ahead[:, None, :]
        pairs += (both / both.sum((1, 2), keepdims=True)).sum(0)
        back = ahead @ step.T
        back /= back.sum(1, keepdims=True)
    beta[:, 0] = back
    gamma = alpha * beta
    return gamma / gamma.sum(2, keepdims=True), pairs


@dataclass
class LanguageModel:
    labels: list
    lexicon: frozenset
    weights: np.ndarray
    step: np.ndarray

    def word_scores(self, words: list) -> np.ndarray:
        """Potentials of each word's labels, the largest being one."""
        flat, owner = word_features(words, self.lexicon)
        sizes = np.bincount(owner, minlength=len(words))
        scores = sums_by(self.weights[flat], sizes) / np.sqrt(sizes)[:, None]
        return np.exp(scores - scores.max(1, keepdims=True))


def fit(texts: list, labels: list, rounds: int = ROUNDS, seed: int = 7) -> LanguageModel:
    """Learn from labelled texts. Training sequences join pieces of different texts, so labels change inside them."""
    names = sorted(set(labels))
    if not names:
        return LanguageModel([], frozenset(), np.zeros((1 << FEATURE_BITS, 0), np.float32), np.zeros((0, 0)))
    rng, code = np.random.default_rng(seed), {n: i for i, n in enumerate(names)}
    pieces, counts = [], {}
    for text, label in zip(texts, labels):
        words, at = words_of(text), 0
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        while at < len(words):
            end = at + int(rng.integers(6, SEQUENCE))
            pieces.append((words[at:end], code[label]))
            at = end
    rng.shuffle(pieces) if pieces else None
    lexicon = frozenset(w for w, n in counts.items() if n >= 3)
    vocabulary = {w: i for i, w in enumerate(counts)}
    ids = np.array([vocabulary[w] for words, _ in pieces for w in words], np.int64)
    gold = np.array([y for words, y in pieces for _ in words], np.int64)
    n = len(ids) // SEQUENCE
    if n == 0:  # less than one sequence: repeat what there is
        ids, gold, n = np.resize(ids, SEQUENCE), np.resize(gold, SEQUENCE), int(len(ids) > 0)
    ids, gold, k = ids[:n * SEQUENCE], gold[:n * SEQUENCE], len(names)
    flat, owner = word_features(list(vocabulary), lexicon)
    sizes = np.bincount(owner, minlength=len(vocabulary))
    scale = 1 / np.sqrt(np.maximum(sizes, 1))
    used, uses = np.unique(flat, return_counts=True)
    by_feature = owner[np.argsort(flat, kind="stable")]
    weights, step = np.zeros((1 << FEATURE_BITS, k)), np.zeros((k, k))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(step), np.zeros_like(step)]
    truth = np.eye(k)[gold].reshape(n, SEQUENCE, k)
    steps_seen = np.zeros((k, k))
    np.add.at(steps_seen, (truth.argmax(2)[:, :-1].ravel(), truth.argmax(2)[:, 1:].ravel()), 1)
    for t in range(1, rounds + 1 if n else 1):
        scores = sums_by(weights[flat], sizes) * scale[:, None]
        psi = scores[ids].reshape(n, SEQUENCE, k)
        gamma, pairs = forward_backward(np.exp(psi - psi.max(2, keepdims=True)), np.exp(step))
        wrong = (gamma - truth).reshape(-1, k)
        by_word = np.stack([np.bincount(ids, wrong[:, y], len(sizes)) for y in range(k)], 1) * scale[:, None]
        slope = 1e-5 * weights
        slope[used] += sums_by(by_word[by_feature], uses) / n
        for value, g, first, second in ((weights, slope, *moments[:2]), (step, (pairs - steps_seen) / n, *moments[2:])):
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            value -= 0.15 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return LanguageModel(names, lexicon, weights.astype(np.float32), np.exp(step - step.max()))


def training_rows(docs: DataFrame, id_col: str, text_col: str, label_col: str,
                  per_language: int = TRAIN_ROWS_PER_LANGUAGE, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, label): a piece of at most ``chars`` characters, from anywhere in the text, of at most
    ``per_language`` rows with each label, whose crc32(id as text) mod 4 is not 2.

    A label's rows are dealt to parts by hash, each with an equal share of ``per_language``. The rows of a part are
    first cut to that share in chunks of input partitions, so that no task sorts more of a frequent label than the
    share of each chunk. Which rows are taken depends on ids and texts alone.
    """
    text, order = F.col(f"`{text_col}`"), F.xxhash64(F.col(f"`{id_col}`"))
    parts = max(1, min(SAMPLE_PARTS, per_language))
    rows = docs.where(F.col(f"`{label_col}`").isNotNull() & text.isNotNull() & ~held_out(id_col)).select(
        F.col(f"`{label_col}`").cast("string").alias("label"), order.alias("order"), F.col(f"`{id_col}`").alias("id"),
        F.pmod(F.xxhash64(order, text), F.lit(parts)).alias("part"), (F.spark_partition_id() % SAMPLE_CHUNKS).alias("chunk"),
        F.substring(text, (F.pmod(order, F.greatest(F.length(text) - chars, F.lit(1))) + 1).cast("int"), F.lit(chars)).alias("text"))
    for keys in (["label", "part", "chunk"], ["label", "part"]):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy("order", "id", "text"))
        rows = rows.withColumn("number", number).where(f"number <= {per_language // parts}").drop("number")
    return rows.select("text", "label")


def held_out(id_col: str = "doc_id"):
    """Whether crc32(id as text) mod 4 is 2; a null id is neither held out nor learned from."""
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2


def fit_on(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **options) -> LanguageModel:
    rows = sorted((r["label"], r["text"]) for r in training_rows(docs, id_col, text_col, label_col, **options).collect())
    return fit([t for _, t in rows], [y for y, _ in rows])


class Labeller:
    """Mean label probabilities of texts, with the scores of frequent words kept between batches."""

    def __init__(self, model: LanguageModel):
        self.model, self.known = model, {}
        self.scores = np.zeros((1024, len(model.labels)))

    def _numbers(self, words: list):
        """Numbers of the words into ``self.scores``, which grows up to a bound and is emptied beyond it."""
        new = list({w for w in words if w not in self.known})
        if len(self.known) + len(new) > WORDS_KEPT and self.known:
            self.known, new = {}, list(set(words))
        if new:
            first = len(self.known)
            while first + len(new) > len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.scores[first:first + len(new)] = self.model.word_scores(new)
            self.known.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def __call__(self, texts: list) -> np.ndarray:
        """(texts, labels): the mean probability of each label over the words; zero rows for texts without words."""
        found = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in found], np.int64)
        k = len(self.model.labels)
        if not sizes.sum() or not k:
            return np.zeros((len(texts), k))
        psi = self.scores_of([w for words in found for w in words])
        return lane_means(psi, sizes, self.model.step)

    def scores_of(self, words: list) -> np.ndarray:
        parts = []
        for at in range(0, len(words), WORDS_KEPT):
            numbers = self._numbers(words[at:at + WORDS_KEPT])
            parts.append(self.scores[numbers])
        return np.concatenate(parts)


def lane_means(psi: np.ndarray, sizes: np.ndarray, step: np.ndarray, lane: int = LANE) -> np.ndarray:
    """Mean word label probabilities of sequences that lie one after the other in ``psi``, exact for any length.

    Sequences are cut into lanes that run side by side. The product of a lane's steps carries messages over lanes
    of one sequence, in both directions; then each lane runs forward and backward from its messages.
    """
    k, total = psi.shape[1], len(sizes)
    begins = np.cumsum(sizes) - sizes
    lanes = -(-sizes // lane)
    owner = np.repeat(np.arange(total), lanes)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start, length = begins[owner] + inner * lane, np.minimum(sizes[owner] - inner * lane, lane)
    order = np.argsort(-length, kind="stable")
    owner, inner, start, length = owner[order], inner[order], start[order], length[order]
    active = np.searchsorted(-length, -np.arange(lane), side="left")  # lanes longer than t

    enter, leave = np.full((len(owner), k), 1 / k), np.ones((len(owner), k))
    place = np.empty(len(owner), np.int64)
    place[np.lexsort((inner, owner))] = np.arange(len(owner))
    where = np.argsort(place)  # lanes by sequence and number
    many = np.flatnonzero(lanes[owner] > 1)
    if len(many):
        product = np.broadcast_to(np.eye(k), (len(many), k, k)).copy()
        here = np.searchsorted(-length[many], -np.arange(lane), side="left")
        for t in range(lane):
            m = here[t]
            if not m:
                break
            moved = (product[:m].reshape(-1, k) @ step).reshape(m, k, k)
            if t == 0:
                moved[inner[many[:m]] == 0] = 1
            product[:m] = moved * psi[start[many[:m]] + t][:, None, :]
            if t % 8 == 7:
                product[:m] /= product[:m].max((1, 2), keepdims=True)
        product /= product.max((1, 2), keepdims=True)
        full = np.empty(len(owner), np.int64)
        full[many] = np.arange(len(many))
        first = np.cumsum(lanes) - lanes
        for c in range(1, int(lanes.max())):
            seqs = np.flatnonzero(lanes > c)
            now, before = where[first[seqs] + c], where[first[seqs] + c - 1]
            v = np.einsum("nk,nkj->nj", enter[before], product[full[before]])
            enter[now] = v / v.sum(1, keepdims=True)
        for c in range(int(lanes.max()) - 2, -1, -1):
            seqs = np.flatnonzero(lanes > c + 1)
            now, after = where[first[seqs] + c], where[first[seqs] + c + 1]
            v = np.einsum("njk,nk->nj", product[full[after]], leave[after])
            leave[now] = v / v.sum(1, keepdims=True)

    alpha, at = np.empty_like(psi), enter
    for t in range(lane):
        m = active[t]
        if not m:
            break
        moved = at[:m] @ step
        if t == 0:
            moved[inner[:m] == 0] = 1
        at = moved * psi[start[:m] + t]
        at /= at.sum(1, keepdims=True)
        alpha[start[:m] + t] = at
    sums, back = np.zeros((len(owner), k)), leave.copy()
    for t in range(lane - 1, -1, -1):
        m = active[t]
        if not m:
            continue
        rows = start[:m] + t
        both = alpha[rows] * back[:m]
        sums[:m] += both / both.sum(1, keepdims=True)
        ahead = (psi[rows] * back[:m]) @ step.T
        back[:m] = ahead / ahead.sum(1, keepdims=True)
    out = np.stack([np.bincount(owner, sums[:, y], total) for y in range(k)], 1)
    return out / np.maximum(sizes, 1)[:, None]


def label_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and lang_pred, score, for whole texts, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was learned.
    Columns of ``docs`` with the name of a new column are replaced. Each row gives one row.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    source = docs.select(*[F.col(f"`{c}`") for c in others])
    schema = StructType([*source.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    held, at_text = [], others.index(text_col)

    def work(batch):
        if not held:
            held.append(Labeller(model))
        texts, means = batch.column(at_text).to_pylist(), []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and end - at < DOCS_AT_ONCE and (chars < CHARS_AT_ONCE or end == at):
                chars += len(texts[end] or "")
                end += 1
            means.append(held[0](texts[at:end]))
            at = end
        means = np.concatenate(means)
        best = means.argmax(1) if means.shape[1] else np.zeros(len(means), int)
        score = means.max(1, initial=0)
        return {c: batch.column(i) for i, c in enumerate(others)} | {
            "lang_pred": [model.labels[b] if s > 0 else UNDETERMINED for b, s in zip(best, score)],
            "score": np.minimum(score, 1.0)}

    return map_batches(source, work, schema)


def keep_identified(docs: DataFrame, model: LanguageModel, text_col: str = "text", least_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with a determined language of at least this score, with their own columns. The score is a
    share over words, low in a clear text of several languages, so only undetermined texts go unless one is given."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    marked = label_languages(row, model)
    return marked.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)).select("doc.*")
