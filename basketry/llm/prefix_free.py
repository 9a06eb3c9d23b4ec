"""Repeated passages by windows anchored at content-chosen phrase ends.

A rolling hash over a few bytes triggers the ends of phrases, so equal content is parsed alike wherever it lies.
Only this part of prefix-free parsing is used. There is no phrase dictionary, no parse and no suffix array of
either, and nothing is sorted: windows of ``length`` bytes that begin in the same phrase are taken together and
counted by digests of what the phrase suffix and the phrases after it spell; what is counted twice is a repeat.
"""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from basketry.llm.common import cover, spans_of, text_key
from basketry.llm.repeats import distinct_texts, each_alone, map_texts, repeated_windows

LENGTH = 400
TRIGGER_BYTES = 8
PHRASE_BYTES = 80
SHORT_PHRASE_BYTES = 8
TAIL_BYTES = 128
PART_WINDOWS = 16
SEGMENT = 1 << 20

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def triggers(data: bytes, every: int, kind: int) -> np.ndarray:
    """Places whose rolling hash of the next bytes is among the 1/every smallest: on average one in ``every``."""
    found, limit = [], np.uint64((1 << 64) // every)
    for at in range(0, len(data) - TRIGGER_BYTES + 1, SEGMENT):
        n = min(SEGMENT, len(data) - TRIGGER_BYTES + 1 - at)
        words = np.ndarray((n,), "<u8", data, at, (1,))
        mixed = (words ^ words >> np.uint64(29)) * _MIX[kind]
        found.append(np.flatnonzero((mixed ^ mixed << np.uint64(31)) * _MIX[1 - kind] < limit) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _classes(anchor, first, last, tail):
    """Cut runs of windows by how far they begin before the anchor, in steps of ``tail`` bytes."""
    near, far = (anchor - last) // tail, (anchor - first) // tail
    n = far - near + 1
    row = np.repeat(np.arange(len(anchor)), n)
    step = near[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    a = anchor[row]
    return a, step, np.maximum(first[row], a - (step + 1) * tail + 1), np.minimum(last[row], a - step * tail)


def phrase_runs(text: str, length: int = LENGTH, tail: int = TAIL_BYTES, phrase: int = PHRASE_BYTES):
    """Runs of the windows of a text, by the first phrase end inside the window.

    A window without a phrase end goes by the first end of a short phrase; one without that, by its own start.
    """
    data = text.encode()
    n, reach = len(data), length - TRIGGER_BYTES
    if n < length:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 2
    ends = triggers(data, phrase, 0)
    before = np.concatenate(([-1], ends[:-1])) if len(ends) else ends
    parts = [(ends, np.maximum(before + 1, ends - reach), np.minimum(ends, n - length), 0)]
    gap_from = np.concatenate(([0], ends + 1))
    gap_to = np.minimum(np.concatenate((ends - reach - 1, [n - length])), n - length)
    for a, b in zip(gap_from[gap_to >= gap_from].tolist(), gap_to[gap_to >= gap_from].tolist()):
        short = triggers(data[a:b + length], SHORT_PHRASE_BYTES, 1) + a
        at = np.searchsorted(short, np.arange(a, b + 1))
        next_one = np.append(short, n + length)[at]
        place = np.arange(a, b + 1)
        own = next_one > place + reach
        anchor = np.where(own, place, next_one)
        cut = np.flatnonzero(np.diff(anchor, prepend=-1))
        parts.append((anchor[cut], place[cut], np.append(cut[1:] - 1 + a, b), 1))
    out = []
    for anchor, first, last, kind in parts:
        real = first <= last
        a, step, first, last = _classes(anchor[real], first[real], last[real], tail)
        out.append((a, step, first, last, np.full(len(a), kind)))
    a, step, first, last, kind = (np.concatenate(c) for c in zip(*out))
    core, rid = _digests(data, a, step, first, last, step * 2 + kind, length, tail)
    return core, rid, first, last - first + 1


def part_runs(data: bytes, start: int, n: int, length: int = LENGTH, phrase: int = PHRASE_BYTES,
              windows: int = PART_WINDOWS):
    """A run cut into parts of at most ``windows`` windows, by how far they begin before the run's anchor."""
    inside = data[start:start + length]
    ends = triggers(inside, phrase, 0)
    ends = ends if len(ends) else triggers(inside, SHORT_PHRASE_BYTES, 1)
    anchor = start + int(ends[0]) if len(ends) else start
    a, step, first, last = _classes(*(np.array([x]) for x in (anchor, start, start + n - 1)), windows)
    return *_digests(data, a, step, first, last, step, length, windows), first, last - first + 1


def _digests(data, anchor, step, first, last, seed, length, tail):
    """Digests of what all windows of a class share, and of all that the windows of a run hold."""
    view, digest = memoryview(data), xxhash.xxh3_64_intdigest
    begin, end = anchor - step * tail, anchor + length - (step + 1) * tail + 1
    return (np.array([digest(view[s:e], k) for s, e, k in zip(b.tolist(), e.tolist(), k.tolist())], np.uint64)
            for b, e, k in ((begin, end, seed), (first, last + length, anchor - first)))


def window_digests(text: str, runs: list, length: int = LENGTH) -> list:
    view = memoryview(text.encode())
    return [xxhash.xxh3_128_digest(view[p:p + length]) for start, n in runs for p in range(start, start + n)]


def _without(text: str, starts: list, numbers: list, length: int = LENGTH):
    data = np.frombuffer(text.encode(), np.uint8)
    covered = cover(len(data), starts, np.asarray(numbers, np.int64) + length - 1) if starts else np.zeros(len(data), bool)
    kept = data[~covered].tobytes()
    return len(data), int(covered.sum()), len(spans_of(covered)[0]), hashlib.sha256(kept).hexdigest(), kept


_RESULT = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()),
           StructField("kept_sha256", StringType())]


def _parsed(docs: DataFrame, id_col: str, text_col: str, length: int, with_bytes: bool) -> DataFrame:
    texts = distinct_texts(docs, id_col, text_col)
    tail, phrase = min(TAIL_BYTES, length // 3), min(PHRASE_BYTES, length // 5)
    marks = repeated_windows(
        texts, "copies", each_alone(lambda t: phrase_runs(t, length, tail, phrase)),
        [lambda data, start, n: part_runs(data, start, n, length, phrase, min(PART_WINDOWS, tail))],
        lambda t, runs: window_digests(t, runs, length), False)
    schema = StructType(_RESULT + [StructField("kept", BinaryType())] * with_bytes)
    return map_texts(texts, marks, lambda t, s, n: _without(t, s, n, length)[:len(schema)], schema)


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256): bytes of each row covered by a string of ``length``
    bytes that also starts anywhere else, and what is left.

    Texts are UTF-8, null is empty, texts shorter than ``length`` keep all bytes. Each row gives one row, also
    with a null or repeated id; equal rows repeat each other. ``length`` is at least 24. Other columns are not read.
    """
    found = _parsed(docs, id_col, text_col, length, False)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(F.col(f"`{text_col}`")).alias("key"))
    return rows.join(found, "key").select(F.col("id").alias(id_col), *[f.name for f in _RESULT])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with its columns, the repeated bytes of each text removed; characters cut in part go whole.

    A null text stays null. Other texts are kept byte by byte as :func:`find_repeats` counts them.
    """
    changed = _parsed(docs, id_col, text_col, length, True).where("n_removed > 0").select(
        F.col("key").alias("changed_key"), F.col("kept").alias("kept_bytes"))
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         text_key(F.col(f"`{text_col}`")).alias("key")).join(changed, F.col("key") == F.col("changed_key"), "left")
    text = F.when(F.col("changed_key").isNull(), F.col("doc")[text_col]).otherwise(_valid_text(F.col("kept_bytes")))
    return joined.select(*[text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])


def _valid_text(column):
    """UTF-8 bytes as text without the bytes of characters that were cut."""
    from pyspark.sql.functions import pandas_udf
    import pandas as pd

    @pandas_udf("string")
    def decode(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return decode(column)
