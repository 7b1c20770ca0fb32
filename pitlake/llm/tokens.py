"""Token ids of whole texts, by the ``tokenizers`` library.

A byte-level BPE works inside one pre-token at a time, so each distinct
pre-token is encoded once by the library and its ids are reused.  Texts with
characters on which pattern libraries may disagree, and vocabularies of other
kinds, go to the library whole.
"""

from __future__ import annotations

import json
import re

import numpy as np

# The letters, numbers and white space among the characters up to U+024F, as the
# byte-level pre-tokenizer's pattern classes them; a text with others is encoded whole.
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = r"\t\n\x0b\x0c\r \xa0"
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+").findall
_ODD = re.compile(r"[^\t\n\x0b\x0c\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞₠-₿]").search


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """``payloads(texts)``: for each text its ids as little-endian unsigned 32-bit integers."""

    LIMIT = 1_000_000  # pre-tokens kept
    TOGETHER = 500  # new pre-tokens in one call, a line each

    def __init__(self, vocabulary: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.library.encode_special_tokens = True
        with open(vocabulary, encoding="utf-8") as f:
            about = json.load(f)
        before = about.get("pre_tokenizer") or {}
        line = self.library.encode("\n", add_special_tokens=False).ids
        self.by_pre_token = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not about.get("normalizer") and len(line) == 1
        self.line = line[0] if line else -1
        self.known: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        """Encode new pre-tokens; those without white space inside go to the library as lines of one text."""
        lines = [w for w in words if len(w) > 1 and not w[1:].isspace()]
        rest = list(words.difference(lines))
        self.known.update(zip(rest, self._encode(rest)))
        for i in range(0, len(lines), self.TOGETHER):
            some = lines[i : i + self.TOGETHER]
            payload = self._encode(["\n".join(some)])[0]
            ends = np.flatnonzero(np.frombuffer(payload, "<u4") == self.line).tolist()
            ends.append(len(payload) // 4)
            if len(ends) != len(some):
                self.known.update(zip(some, self._encode(some)))
                continue
            start = 0
            for word, end in zip(some, ends):
                self.known[word] = payload[4 * start : 4 * end]
                start = end + 1

    def payloads(self, texts: list[str | None]) -> list[bytes]:
        cut = [[] if not text else _CUT(text) if self.by_pre_token and not _ODD(text) else None for text in texts]
        if len(self.known) > self.LIMIT:
            self.known.clear()
        known = self.known
        new = set().union(*filter(None, cut)).difference(known)
        if new:
            self._learn(new)
        # odd texts one at a time: they may be long
        return [self._encode([text])[0] if words is None else b"".join(map(known.__getitem__, words)) for text, words in zip(texts, cut)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder for each Python worker."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]
