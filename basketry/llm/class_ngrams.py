"""Language-model scoring by Brown's class-based n-grams.

Words belong to classes; a text's probability is that of its sequence of classes times that of each word in its class.
Classes come from exchange clustering, which raises the mutual information of neighbouring classes: the most
frequent words are exchanged one by one to seed the classes, then all words are judged against the classes' counts
at once, in rounds, each by its own neighbours.

Texts are cut into blocks with a word list of their own and turned into places of that list once. What words have to
know of the corpus travels packed, as one row for each block and part of the words, so that no token is shuffled and
a frequent word is one number a block. A part holds the words of one hash value, about ``WORDS_AT_ONCE`` numbers.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType)

from basketry.llm.common import arrow_schema, field, keep_bucketed, stage, tidy

CLASSES = 64  # at most 120, so that a neighbour's class and side fit one byte
SEEDS = 512
SEED_SWEEPS = 6
ROUNDS = 3
BLOCK_BYTES = 6 << 20
PIECE = 1 << 20
WORDS_AT_ONCE = 500_000
GROUPS_AT_ONCE = 8192
# The end of a text in a block's word list; no word holds a blank.
END = b" "


def _pieces(text: str):
    """The words of a text between blanks and ASCII white space, A-Z in lower case, as UTF-8 bytes; a piece of about
    bounded size at a time, cut at white space."""
    data, at = (text or "").encode(), 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].lower().split()
        at = end


def _record(columns, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)


def encode_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text, held): one row for each block of texts, its words and its texts as places in that list."""
    schema = StructType([
        StructField("block", LongType()), StructField("words", BinaryType()), StructField("n_words", LongType()), StructField("tokens", BinaryType()),
        StructField("ids", ArrayType(docs.schema["id"].dataType)), StructField("held", ArrayType(BooleanType())), StructField("sizes", ArrayType(LongType()))])

    def encode(batches):
        from pyspark import TaskContext

        number, kinds = TaskContext.get().partitionId() << 33, arrow_schema(schema)
        known, parts, ids, held, sizes, size = {END: 0}, [], [], [], [], 0
        block = lambda: _record([[x] for x in (
            number, b"\n".join(list(known)[1:]), len(known) - 1, np.concatenate(parts).tobytes(), ids, held, sizes)], kinds)
        for batch in batches:
            for k in range(batch.num_rows):
                text, n = batch.column(1)[k].as_py() or "", 1
                for words in _pieces(text):
                    for w in dict.fromkeys(words):
                        if w not in known:
                            known[w] = len(known)
                    parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                    n += len(words)
                parts.append(np.zeros(1, np.int32))
                ids.append(batch.column(0)[k].as_py())
                held.append(batch.column(2)[k].as_py())
                sizes.append(n)
                size += len(text)
                if size >= BLOCK_BYTES or len(ids) >= 50_000:
                    yield block()
                    number, known, parts, ids, held, sizes, size = number + 1, {END: 0}, [], [], [], [], 0
        if ids:
            yield block()

    return docs.select("id", "text", "held").mapInArrow(encode, schema)


class Block:
    """A block read back. Its words that training texts of any block hold are listed part by part in ``place``; ``known`` and ``cls`` are what has
    been learned of each word of its list: the count, and the class (``classes``: the end of a text; one more: none)."""

    def __init__(self, row: dict, classes: int, seeded: dict):
        self.number = row["block"].as_py()
        self.tokens = np.frombuffer(row["tokens"].as_buffer(), np.int32)
        self.sizes = row["sizes"].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.held = row["held"].values.to_numpy(zero_copy_only=False).astype(bool)
        self.ids = row["ids"].values
        self.train = np.repeat(~self.held, self.sizes)
        size = row["n_words"].as_py() + 1
        self.known, self.cls = np.zeros(size, np.int64), np.full(size, classes + 1, np.int64)
        if "words" in row:
            words = row["words"].as_py()
            self.words = [END, *(words.split(b"\n") if words else ())]
            if seeded:
                for k, w in enumerate(self.words):
                    self.cls[k] = seeded.get(w, classes + 1)
        self.parts, self.place, self.rank = [], [], []
        for chunk in self._chunks(row, "counted"):
            self.parts.append(chunk["part"].as_py())
            self.place.append(np.frombuffer(chunk["place"].as_buffer(), np.int32))
            self.rank.append(chunk["rank"].as_py())
            self.known[self.place[-1]] = np.frombuffer(chunk["known"].as_buffer(), np.int64)
        for place, chunk in zip(self.place, self._chunks(row, "classed")):
            self.cls[place] = np.frombuffer(chunk["cls"].as_buffer(), np.uint8)
        self.cls[0] = classes

    def _chunks(self, row, name):
        found = row.get(name)
        return sorted(found.values, key=lambda c: c["part"].as_py()) if found is not None and found.is_valid else ()

    def train_pairs(self, of: np.ndarray):
        """(token before, token, ``of`` the token before, ``of`` the token) of the training tokens; before each text's first
        token stands the end of a text."""
        tokens = self.tokens[self.train]
        now = of[tokens]
        return np.concatenate(([0], tokens[:-1])), tokens, np.concatenate(([of[0]], now[:-1])), now


def _each_block(frame: DataFrame, classes: int, function, schema: StructType, seeded: dict = None, per_task: bool = False) -> DataFrame:
    """``function(block)`` yields records' columns. With ``per_task`` it is made anew in each task, as what takes a block and
    what gives the columns at the end."""
    def run(batches):
        kinds = arrow_schema(schema)
        work, end = function() if per_task else (function, None)
        for batch in batches:
            for k in range(batch.num_rows):
                for out in work(Block({n: batch.column(i)[k] for i, n in enumerate(batch.schema.names)}, classes, seeded)) or ():
                    yield _record(out, kinds)
        if end:
            yield _record(end(), kinds)
        tidy()

    return frame.mapInArrow(run, schema)


def _each_part(rows: DataFrame, function, schema: StructType) -> DataFrame:
    """``function(rows of one part)`` yields records' columns. A part's rows, one for each block, meet in one task."""
    def run(batches):
        kinds, now, held = arrow_schema(schema), None, []
        for batch in batches:
            for row in (batch.slice(k, 1) for k in range(batch.num_rows)):
                part = row.column(0)[0].as_py()
                if part != now and held:
                    yield from (_record(out, kinds) for out in function(now, held))
                    held = []
                now = part
                held.append({n: c[0] for n, c in zip(row.schema.names, row.columns)})
        if held:
            yield from (_record(out, kinds) for out in function(now, held))
        held = []
        tidy()

    return rows.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, schema)


_COUNTED = StructType([StructField("part", IntegerType()), StructField("block", LongType()), StructField("words", BinaryType()),
                       StructField("place", BinaryType()), StructField("n", BinaryType())])
# Rows with a block: what its words learn; rows with a word: the most frequent of the part; the last: the part's words.
_LEARNED = StructType([StructField("part", IntegerType()), StructField("block", LongType()), StructField("place", BinaryType()),
                       StructField("rank", BinaryType()), StructField("known", BinaryType()), StructField("word", BinaryType()), StructField("n", LongType())])


def count_words(blocks: DataFrame, classes: int, parts: int, tops: int) -> DataFrame:
    """Counts in the training texts of all words that occur there, the words of a part in the order of their bytes."""
    def count(block):
        n = np.bincount(block.tokens[block.train], minlength=len(block.words))
        at = np.arange(1, len(block.words))  # also words of held-out texts alone, which other blocks may know
        part = np.array([zlib.crc32(block.words[i]) % parts for i in at.tolist()], np.int64)
        at = at[np.argsort(part, kind="stable")]
        used, first = np.unique(np.sort(part), return_index=True)
        for p, own in zip(used.tolist(), np.split(at, first[1:])):
            yield [[x] for x in (p, block.number, b"\n".join([block.words[i] for i in own.tolist()]), own.astype(np.int32).tobytes(), n[own].astype(np.int64).tobytes())]

    def settle(part, rows):
        words = [r["words"].as_py().split(b"\n") for r in rows]
        listed = sorted(set().union(*words))
        rank = dict(zip(listed, range(len(listed))))
        ranks = [np.fromiter(map(rank.__getitem__, w), np.int32, len(w)) for w in words]
        known = np.zeros(len(listed), np.int64)
        for r, own in zip(rows, ranks):
            known[own] += np.frombuffer(r["n"].as_buffer(), np.int64)
        used = known > 0
        place_of = np.cumsum(used) - 1
        for r, own in zip(rows, ranks):
            keep = used[own]
            if keep.any():
                place, own = np.frombuffer(r["place"].as_buffer(), np.int32)[keep], own[keep]
                yield [[x] for x in (part, r["block"].as_py(), place.tobytes(), place_of[own].astype(np.int32).tobytes(), known[own].tobytes(), None, None)]
        first = sorted((-k, w) for k, w in zip(known.tolist(), listed) if k)[:tops]
        none = [None] * (len(first) + 1)
        yield [[part] * len(none), none, none, none, none, [w for _, w in first] + [None], [-k for k, _ in first] + [int(used.sum())]]

    return _each_part(_each_block(blocks, classes, count, _COUNTED), settle, _LEARNED)


_NEAR = StructType([StructField("part", IntegerType()), StructField("block", LongType()), *[StructField(c, BinaryType()) for c in (
    "rank", "own", "lengths", "keys", "counts")]])
_CLASSED = StructType([StructField("part", IntegerType()), StructField("block", LongType()), StructField("cls", BinaryType())])


def exchange_round(blocks: DataFrame, classes: int, seeded: dict, decide) -> DataFrame:
    """New classes of all training words. ``decide(own, group, key, n)`` gives those of a part's words, of which entries
    say that word ``group`` has ``n`` neighbours ``key``: classes that follow it, and ``classes + 2`` on, that precede it."""
    width = classes + 2

    def gather(block):
        before_token, token, before, now = block.train_pairs(block.cls)
        code = np.concatenate([before_token.astype(np.int64) * 256 + now, token.astype(np.int64) * 256 + width + before])
        code, n = np.unique(code, return_counts=True)
        bounds = np.searchsorted(code, np.arange(len(block.cls) + 1, dtype=np.int64) * 256)
        for part, place, rank in zip(block.parts, block.place, block.rank):
            lengths = np.diff(bounds)[place]
            at = np.repeat(bounds[place] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            yield [[x] for x in (part, block.number, rank, block.cls[place].astype(np.uint8).tobytes(), lengths.astype(np.int32).tobytes(),
                                 (code[at] & 255).astype(np.uint8).tobytes(), n[at].astype(np.uint32).tobytes())]

    def settle(part, rows):
        read = lambda name, kind: [np.frombuffer(r[name].as_buffer(), kind) for r in rows]
        ranks = read("rank", np.int32)
        rank = np.concatenate(ranks)
        own = np.zeros(int(rank.max()) + 1, np.int64)
        own[rank] = np.concatenate(read("own", np.uint8))
        code = np.repeat(rank.astype(np.int64), np.concatenate(read("lengths", np.int32))) << 8 | np.concatenate(read("keys", np.uint8))
        code, inverse = np.unique(code, return_inverse=True)
        n = np.bincount(inverse, np.concatenate(read("counts", np.uint32))).astype(np.int64)
        cls = decide(own, code >> 8, code & 255, n).astype(np.uint8)
        for r, of in zip(rows, ranks):
            yield [[x] for x in (part, r["block"].as_py(), cls[of].tobytes())]

    return _each_part(_each_block(blocks, classes, gather, _NEAR, seeded), settle, _CLASSED)


def _f(x):
    return x * np.log(np.maximum(x, 1))


class ClassGains:
    """What joining each class adds to the sum of x log x that exchange clustering raises, by the counts ``totals`` of
    pairs of neighbouring classes."""

    def __init__(self, totals: np.ndarray):
        width = len(totals)
        self.classes = width - 2
        # Row ``key``: the counts of each class with that neighbour.
        self.seen = np.concatenate([totals[:self.classes].T, totals[:, :self.classes]]).astype(float)
        self.value = _f(self.seen)
        self.one = _f(self.seen + 1) - self.value
        self.sums = np.stack([totals.sum(1), totals.sum(0)])[:, :self.classes].astype(float)

    def __call__(self, group, key, n, own) -> np.ndarray:
        """(words, classes). Entries, in the order of their words, say that word ``group`` has ``n`` neighbours ``key``; ``own`` is
        each word's class now, whose counts hold the word's own."""
        words, width = len(own), len(self.seen) // 2
        single = n == 1
        often = np.zeros((words, len(self.seen)))
        often[group[single], key[single]] = 1
        gains = often @ self.one
        g, k, m = group[~single], key[~single], n[~single].astype(float)
        if len(g):
            pair, inverse = np.unique(n[~single] * 256 + k, return_inverse=True)
            change = _f(self.seen[pair % 256] + (pair // 256)[:, None]) - self.value[pair % 256]
            first = np.flatnonzero(np.diff(g, prepend=-1))
            gains[g[first]] += np.add.reduceat(change[inverse], first)
        # The word's own class holds its counts already.
        mine = np.flatnonzero(own[group] < self.classes)
        g, k, m = group[mine], key[mine], n[mine].astype(float)
        stay = self.seen[k, own[g]]
        correction = self.value[k, own[g]] - _f(np.maximum(stay - m, 0)) - (_f(stay + m) - self.value[k, own[g]])
        np.add.at(gains, (g, own[g]), correction)
        at = np.flatnonzero(own < self.classes)
        for direction, sums in enumerate(self.sums):
            on = key // width == direction
            times, inverse = np.unique(np.bincount(group[on], n[on], words), return_inverse=True)
            loss = (_f(sums[None, :] + times[:, None]) - _f(sums)[None, :])[inverse]
            stay = sums[own[at]]
            loss[at, own[at]] = _f(stay) - _f(np.maximum(stay - times[inverse[at]], 0))
            gains -= loss
        return gains


def _chooser(totals: np.ndarray, turn: int):
    """Which class each word takes in a round: the first round all words, later ones half of them, so that neighbours
    don't move past each other."""
    classes = len(totals) - 2
    gains_of = ClassGains(totals)

    def decide(own, group, key, n):
        cls = own.copy()
        seen = key % (classes + 2) <= classes
        group, key, n = group[seen], key[seen], n[seen]
        bounds = np.searchsorted(group, np.arange(0, len(own) + GROUPS_AT_ONCE, GROUPS_AT_ONCE))
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            at = np.arange(k * GROUPS_AT_ONCE, min(len(own), (k + 1) * GROUPS_AT_ONCE))
            gains = gains_of(group[a:b] - at[0], key[a:b], n[a:b], own[at])
            best, now = gains.argmax(1), own[at]
            kept = np.minimum(now, classes - 1)
            row = np.arange(len(at))
            stays = (now < classes) & ((gains[row, kept] >= gains[row, best] - 1e-6) | (turn > 0) & (at % 2 != turn % 2))
            cls[at] = np.where(stays, now, best)
        return cls

    return decide


def cells(frame: DataFrame, classes: int, shape: tuple, add, seeded: dict = None) -> np.ndarray:
    """Counts of bounded shape, summed over all blocks; ``add(block, counts)`` adds those of one."""
    schema = StructType([StructField("cell", LongType()), StructField("n", LongType())])
    size = int(np.prod(shape))

    def function():
        counts = np.zeros(size, np.int64)

        def end():
            used = np.flatnonzero(counts)
            return [used, counts[used]]

        return lambda block: add(block, counts), end

    found = _each_block(frame, classes, function, schema, seeded, True).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(shape)


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each word but the first, which is the end of a text, by exchanging one word after the other.

    ``pairs`` counts neighbouring words. Words start in turn in the classes and move to the class that gains most.
    """
    words = len(pairs)
    width = classes + 2
    own = np.concatenate(([classes], np.arange(words - 1) % classes))
    totals = np.zeros((width, width), np.int64)
    np.add.at(totals, (own[:, None], own[None, :]), pairs)
    for _ in range(sweeps):
        moved = 0
        for w in range(1, words):
            after, before = np.bincount(own, pairs[w], width), np.bincount(own, pairs[:, w], width)
            key = np.concatenate((np.flatnonzero(after), width + np.flatnonzero(before)))
            n = np.concatenate((after[after > 0], before[before > 0])).astype(np.int64)
            if not len(n):
                continue
            gains = ClassGains(totals)(np.zeros(len(key), np.int64), key, n, own[w:w + 1])[0]
            best = int(gains.argmax())
            if gains[best] > gains[own[w]] + 1e-6:
                old = own[w]
                for a, b in ((old, -1), (best, 1)):
                    own[w] = a
                    now_after, now_before = np.bincount(own, pairs[w], width).astype(np.int64), np.bincount(own, pairs[:, w], width).astype(np.int64)
                    totals[a] += b * now_after
                    totals[:, a] += b * now_before
                    totals[a, a] -= b * pairs[w, w]
                own[w] = best
                moved += 1
        if not moved:
            break
    return own[1:]


class Model:
    """Probabilities of classes after two classes, and of a word not seen, from counts. Class numbers: the words'
    classes, then the end of a text, then words not seen."""

    def __init__(self, triples: np.ndarray, once_after: np.ndarray):
        width = len(triples)
        pairs = triples.sum(0)
        single = pairs.sum(0).astype(float)
        total = single.sum()
        self.tokens = int(total)
        self.class_counts = single

        def smoothed(counts, lower):
            """Witten-Bell: as much weight for the shorter context as there are kinds of followers."""
            n, kinds = counts.sum(-1, keepdims=True), (counts > 0).sum(-1, keepdims=True)
            return np.where(n > 0, (counts + kinds * lower) / np.maximum(n + kinds, 1), lower)

        one = single / max(total, 1.0)
        two = smoothed(pairs, one)
        three = smoothed(triples, two[None, :, :])
        with np.errstate(divide="ignore"):
            self.log_class = np.log10(three)
        # How often a word comes that is new, by the class before it: as often as words seen once.
        rate = (once_after.sum() + 0.5) / (total + 1)
        before = pairs.sum(1)
        new = (once_after + rate) / (before + 1)
        self.log_new, self.log_old = np.log10(new), np.log10(1 - new)
        self.width = width

    def token_scores(self, cls: np.ndarray, known: np.ndarray) -> np.ndarray:
        """log10 probabilities of the tokens of texts that follow one another, each with the end of a text last."""
        end, unseen = self.width - 2, self.width - 1
        one = np.concatenate(([end], cls[:-1]))
        two = np.concatenate(([end, end], cls[:-2]))[:len(cls)]
        two = np.where(one == end, end, two)
        if not self.tokens:
            return np.zeros(len(cls))
        old = self.log_old[one] + self.log_class[two, one, cls] + np.log10(np.maximum(known, 1)) - np.log10(np.maximum(self.class_counts[cls], 1))
        return np.where(cls == unseen, self.log_new[one], old)


def _with_classes(blocks: DataFrame, classed: DataFrame) -> DataFrame:
    """Blocks with the classes of their words; only the classes are shuffled, a byte a word."""
    return blocks.join(classed.groupBy("block").agg(F.collect_list(F.struct("part", "cls")).alias("classed")), "block", "left")


class Fitted:
    """Blocks with counts, the classes of their words, the model, and how many different tokens it was trained on."""

    def __init__(self, docs: DataFrame, classes: int = CLASSES, seeds: int = SEEDS, rounds: int = ROUNDS):
        """``docs`` (id, text, held); rows that are held are not learned from."""
        self.classes, width = classes, classes + 2
        texts = keep_bucketed(encode_blocks(docs), "blocks", "block")
        rows = texts.agg(F.sum("n_words")).first()[0] or 0
        parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // WORDS_AT_ONCE))
        counted = stage(count_words(texts, classes, parts, seeds), "word-counts")
        words = counted.where("block is null and word is null").agg(F.sum("n")).first()[0] or 0
        top = counted.where("word is not null").orderBy(F.col("n").desc(), "word").limit(seeds).select("word").collect()
        learned = keep_bucketed(counted.where("block is not null").groupBy("block").agg(
            F.collect_list(F.struct("part", "place", "rank", "known")).alias("counted")), "counts", "block")
        with_words = texts.join(learned, "block", "left")
        self.blocks = with_words.drop("words")
        place = {bytes(r["word"]): k + 1 for k, r in enumerate(top)}

        def seed_pairs(block, counts):
            of = np.array([0, *(place.get(w, -1) for w in block.words[1:])])
            _, _, before, now = block.train_pairs(of)
            both = (before >= 0) & (now >= 0)
            counts += np.bincount(before[both] * (len(place) + 1) + now[both], minlength=len(counts))

        pairs = cells(texts, classes, (len(place) + 1, len(place) + 1), seed_pairs)
        seeded = dict(zip(place, exchange(pairs, classes, SEED_SWEEPS).tolist()))

        def class_pairs(block, counts):
            _, _, before, now = block.train_pairs(block.cls)
            counts += np.bincount(before * width + now, minlength=len(counts))

        self.classed = None
        for turn in range(rounds):
            known_seeds, blocks = (None, _with_classes(self.blocks, self.classed)) if turn else (seeded, with_words)
            totals = cells(blocks, classes, (width, width), class_pairs, known_seeds)
            totals[classes + 1, :] = totals[:, classes + 1] = 0  # words without a class yet
            self.classed = stage(exchange_round(blocks, classes, known_seeds, _chooser(totals, turn)), "word-classes")

        def class_triples(block, counts):
            _, tokens, one, now = block.train_pairs(block.cls)
            two = np.where(one == classes, classes, np.concatenate(([classes], one[:-1])))
            counts[:width ** 3] += np.bincount((two * width + one) * width + now, minlength=width ** 3)
            counts[width ** 3:] += np.bincount(one[(block.known[tokens] == 1) & (tokens > 0)], minlength=width)

        found = cells(_with_classes(self.blocks, self.classed), classes, (width ** 3 + width,), class_triples)
        self.model = Model(found[:width ** 3].reshape(width, width, width), found[width ** 3:])
        self.ends = int(self.model.class_counts[classes])
        self.kinds = int(words) + (self.ends > 0)

    def each_block(self, function, schema: StructType) -> DataFrame:
        return _each_block(_with_classes(self.blocks, self.classed), self.classes, function, schema)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, classes: int = CLASSES,
                seeds: int = SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row.

    Learned from the rows for which the condition ``held_out`` is not true. Tokens are words with A-Z in lower case and
    the end of the text; a null text is empty. ``base_score`` is log10 of the text by single tokens, half a count added
    for each kind of token and one unknown; ``score`` is log10 of its probability by the class model, perplexity
    ``10 ** (-score / n_tokens)``. All words not seen in training are one word. Without training rows both are 0. Repeated
    rows and ids, and null ids, are texts of their own; an empty table gives no rows. Other columns are not read.
    """
    condition = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), condition.alias("held"))
    fitted = Fitted(source, classes, seeds, rounds)
    model, ends, kinds, total = fitted.model, fitted.ends, fitted.kinds, fitted.model.tokens
    schema = StructType([field(source, "id"), StructField("held_out", BooleanType()), *[StructField(c, LongType()) for c in (
        "n_tokens", "n_known", "train_tokens")], StructField("base_score", DoubleType()), StructField("score", DoubleType())])

    def score(block):
        block.known[0] = ends
        known = block.known[block.tokens]
        first = np.cumsum(block.sizes) - block.sizes
        add = lambda x: np.add.reduceat(x, first)
        base = np.log10((block.known + 0.5) / (total + 0.5 * (kinds + 1)))[block.tokens]
        yield [block.ids, block.held, block.sizes, add((known > 0).astype(np.int64)), np.full(len(first), total), add(base),
               add(model.token_scores(block.cls[block.tokens], known))]

    return fitted.each_block(score, schema).withColumnRenamed("id", id_col)
