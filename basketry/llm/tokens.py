"""Token ids of whole texts, by a public tokenizer whose pieces never cross white space.

Such a tokenizer gives a text the ids of its white-space separated words, one after the other. So each worker
encodes a word once and keeps its ids; the store of words is bounded and never changes a result.
"""

import json
from array import array

_SPACES = bytes.maketrans(b"\t\n\r", b"   ")
_SPACES_LOWER = bytes(32 if c in (9, 10, 13) else c + 32 if 65 <= c < 91 else c for c in range(256))
WORDS_KEPT = 700_000
LONGEST_KEPT = 64
PIECE = 1 << 20


class WordEncoder:
    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.known = {b"": b""}
        # A tokenizer that lowers all letters gives an ASCII word and its lower-case form the same ids; marker strings
        # aside. Other words are encoded as they are, since it composes letters and marks before it lowers them.
        self.lowers = '"Lowercase"' in json.dumps(json.loads(self.tokenizer.to_str())["normalizer"])

    def _encode(self, words: list) -> dict:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return {w: array("I", e.ids).tobytes() for w, e in zip(words, found)}

    def __call__(self, text) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; nothing for null."""
        data, parts, at = (text or "").encode(), [], 0
        lowers = self.lowers and b"<|" not in data
        data = data.translate(_SPACES_LOWER if lowers and data.isascii() else _SPACES)
        lowers = lowers and not data.isascii()
        while at < len(data):
            end = len(data) if len(data) - at <= PIECE else data.rfind(b" ", at, at + PIECE)
            if end <= at:  # a word longer than a piece
                end = data.find(b" ", at + PIECE)
                end = len(data) if end < 0 else end
            words = data[at:end].split(b" ")
            if lowers:
                words = [low if low.isascii() else w for w, low in zip(words, data[at:end].translate(_SPACES_LOWER).split(b" "))]
            parts.append(self._piece(words))
            at = end + 1
        return b"".join(parts)

    def _piece(self, words: list) -> bytes:
        known = self.known
        new = {w for w in words if w not in known}
        if not new:
            return b"".join(map(known.__getitem__, words))
        extra = self._encode(list(new))
        ids = b"".join([known[w] if w in known else extra[w] for w in words])
        if len(known) < WORDS_KEPT:
            known.update((w, x) for w, x in extra.items() if len(w) <= LONGEST_KEPT)
        return ids


def encoder(path: str, special_as_text: bool = False) -> WordEncoder:
    """One encoder for each worker process, the last one asked for. It is held by a module that every worker has, as this
    package travels with the job."""
    import os

    import tokenizers

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    held = tokenizers.__dict__.setdefault("_held_encoder", {})
    if (path, special_as_text) not in held:
        held.clear()
        held[path, special_as_text] = WordEncoder(path, special_as_text)
    return held[path, special_as_text]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
