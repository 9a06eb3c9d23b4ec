"""Repeated word windows by super-k-mers.

The minimiser of a window is the group of words in it that comes first in a fixed order. Consecutive windows with
the same minimiser make one super-k-mer, which goes to the bucket of its minimiser as one piece: first as digests,
and as the words themselves where a bucket holds super-k-mers that differ. There its windows are sorted and
counted exactly, word for word.
"""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from basketry.llm.common import cover, text_key
from basketry.llm.repeats import LAST, distinct_texts, map_texts, repeated_windows

WINDOW = 13
MINIMISER_WORDS = 3
WORDS_AT_ONCE = 200_000

_TABLE = bytes(32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


_PLACE_BITS = 22


def words_of(text: str) -> list:
    """Words between blanks and ASCII white space, as UTF-8 bytes; none for null."""
    return [w for w in (text or "").encode().translate(_TABLE).split(b" ") if w]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


_FACTORS = _scramble(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def word_hashes(words: list) -> np.ndarray:
    """A 64-bit hash of each word: bytes times factors of their places, summed and mixed."""
    found = []
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words[at:at + WORDS_AT_ONCE]
        sizes = np.array([len(w) for w in part]) + 1
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b" ".join(part) + b" ", np.uint8).astype(np.uint64) + np.uint64(1)
        place = np.arange(len(data)) - np.repeat(starts, sizes)
        factors = _scramble(np.arange(int(sizes.max()), dtype=np.uint64)) | np.uint64(1)
        found.append(_scramble(np.add.reduceat(data * factors[place], starts)))
    return np.concatenate(found)


def _first_least(code: np.ndarray, width: int) -> np.ndarray:
    """Place of the least code, by its upper bits, in each window; the first of equals."""
    n = len(code) - width + 1
    if len(code) >= 1 << _PLACE_BITS:
        upper = code >> np.uint64(_PLACE_BITS)
        return np.lib.stride_tricks.sliding_window_view(upper, width).argmin(1) + np.arange(n)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least, have = code & ~low | np.arange(len(code), dtype=np.uint64), 1
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    rest = width - have
    return ((np.minimum(least[:len(least) - rest], least[rest:]) if rest else least) & low).astype(np.int64)


def super_kmers(texts: list, window: int = WINDOW, group: int = MINIMISER_WORDS, cores_only: bool = False):
    """(core, digest, number of the text, start, n) of the runs of windows with the same minimiser, of several texts side
    by side; with ``cores_only`` the cores alone."""
    found = [(i, w) for i, w in enumerate(map(words_of, texts)) if len(w) >= window]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    words = [w for _, own in found for w in own]
    counts = np.array([len(own) for _, own in found])
    begins = np.cumsum(counts) - counts
    hashes = word_hashes(words)
    n = len(words) - group + 1
    code = np.zeros(n, np.uint64)
    for k in range(group):
        code += hashes[k:k + n] * _FACTORS[k]
    code = _scramble(code)
    at = _first_least(code, window - group + 1)
    # Windows that reach into the next text are left out.
    inside = np.ones(len(words), bool)
    ends = np.cumsum(counts)
    inside[(ends[:, None] - np.arange(1, window)).ravel()] = False
    place = np.flatnonzero(inside[:len(at)])
    at = at[place]
    cut = np.flatnonzero(np.diff(at, prepend=-1))
    first, core = place[cut], code[at[cut]]
    if cores_only:
        return core, None, None, None, None
    numbers = np.diff(np.append(cut, len(place)))
    last = first + numbers - 1
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    view, digest = memoryview(b" ".join(words)), xxhash.xxh3_64_intdigest
    stops = np.cumsum(sizes + 1) - 1
    rid = np.array(list(map(digest, map(view.__getitem__, map(slice, (stops - sizes)[first].tolist(), stops[last + window - 1].tolist())),
                            (at[cut] - first).tolist())), np.uint64)
    owner = np.searchsorted(ends, first, side="right")
    return core, rid, np.array([i for i, _ in found])[owner], first - begins[owner], numbers


def packed_words(text: str, runs: list, window: int = WINDOW) -> list:
    """The super-k-mers of some runs as packed strings."""
    words = words_of(text)
    return [b" ".join(words[start:start + n + window - 1]) for start, n in runs]


def unpacked(packed: bytes, window: int = WINDOW) -> list:
    """The windows of a packed super-k-mer."""
    words = packed.split(b" ")
    return [b" ".join(words[k:k + window]) for k in range(len(words) - window + 1)]


def counted_bucket(pieces: list, window: int = WINDOW) -> list:
    """[(number of the super-k-mer, place)] of the windows that a super-k-mer of smaller order in the bucket has.

    ``pieces`` is a list of (order, packed). Sorting brings equal windows together, the smallest order first.
    """
    found, before = [], None
    for w, order, number, place in sorted(
            (w, order, i, k) for i, (order, packed) in enumerate(pieces) for k, w in enumerate(unpacked(packed, window))):
        if w != before:
            before, least = w, order
        elif order > least:
            found.append((number, place))
    return found


def _without(text: str, starts: list, numbers: list, window: int = WINDOW):
    words = words_of(text)
    if not starts:
        return len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest()
    covered = cover(len(words), starts, np.asarray(numbers, np.int64) + window - 1)
    kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
    return len(words), int(covered.sum()), hashlib.sha256(kept).hexdigest()


def find_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id_col, n_words, n_removed, kept_sha256): words of each row covered by a window that also starts in a row
    with a smaller id, and what is left.

    Null has no words; rows with fewer words than a window keep all. Ids are whole numbers; a null id comes after
    all others, and rows with the same id are one document and don't remove from each other. Each row gives one
    row. Other columns are not read.
    """
    texts = distinct_texts(docs, id_col, text_col)
    marks = repeated_windows(texts, "least", lambda t, cores_only: super_kmers(t, window, min(MINIMISER_WORDS, (window + 1) // 2), cores_only), [],
                             lambda t, runs: packed_words(t, runs, window), True,
                             lambda pieces: counted_bucket(pieces, window), lambda packed: unpacked(packed, window))
    schema = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())])
    found = map_texts(texts, marks, lambda t, s, n: _without(t, s, n, window), schema)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(F.col(f"`{text_col}`")).alias("key"))
    # A copy of a text in a later row loses every word of a text that has a window.
    later = (F.coalesce(F.col("id").cast("long"), F.lit(LAST)) > F.col("least")) & (F.col("n_words") >= window)
    return rows.join(found, "key").select(
        F.col("id").alias(id_col), "n_words", F.when(later, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(later, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("kept_sha256")).alias("kept_sha256"))
