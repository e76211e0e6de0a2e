"""Token ids of a public byte-level BPE vocabulary, by the tokenizers library.

Byte-level BPE cuts a text into pre-tokens and encodes each of them alone. So the library encodes
each pre-token once per worker, and a text's ids are the joined ids of its pre-tokens. Texts with
characters beyond U+024F, rare control characters, or an added token's string go through the
library as a whole. Either way the ids are those of ``Tokenizer.encode(text)``. ``Encoder.cut`` gives
the pre-tokens of every text: where the pattern does not hold, by the library's own pre-tokenizer.
"""

from __future__ import annotations

import os
import re

import numpy as np

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t-\r \xa0"
#: The pre-token pattern of the vocabulary for texts of the characters that _OTHER leaves.
PRE_TOKEN = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-ɏ]")
#: The pattern reads at most three characters beyond a pre-token's end.
CONTEXT = 4
#: Pre-tokens kept per worker, about 250 bytes each; then the memory starts anew.
MEMO_SIZE = 500_000


def _byte_letters() -> dict[int, str]:
    """Byte -> its letter in a byte-level vocabulary: printable bytes stand for themselves, the others
    for the letters from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


_LETTERS = _byte_letters()


class _Memo(dict):
    """Pre-token -> its ids as little-endian uint32 bytes, encoded when first met.

    Where the tokenizer is a byte-level one without a normalizer, a pre-token goes straight to the
    library's model, spelt in its letters: the offsets of a whole encoding cost more than its merges.
    """

    def __init__(self, tokenizer) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = tokenizer
        cutter = tokenizer.pre_tokenizer
        byte_level = tokenizer.normalizer is None and isinstance(cutter, ByteLevel) and not cutter.add_prefix_space
        self.model = tokenizer.model if byte_level else None
        self.added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}

    def encode(self, piece: str) -> list[int]:
        if self.model is not None and piece not in self.added:
            spelt = piece.encode().decode("latin-1").translate(_LETTERS)
            return [token.id for token in self.model.tokenize(spelt)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_SIZE:
            self.clear()
        ids = np.array(self.encode(piece), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts with the tokenizer file at ``path``."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo = _Memo(self.tokenizer)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in tokens]
        #: Strings of added tokens that take blanks or word borders around them into account.
        self.loose = [t.content for t in tokens if t.lstrip or t.rstrip or t.single_word or t.normalized]
        longest = [re.escape(a) for a in sorted(self.added, key=len, reverse=True)]
        self.added_pattern = re.compile(f"({'|'.join(longest)})") if longest else None
        #: What a pre-token's cut reads beyond its end: an added token may begin there.
        self.context = CONTEXT + max(map(len, self.added), default=0)

    def plain(self, text: str) -> bool:
        """Whether the pre-token pattern holds for this text."""
        return _OTHER.search(text) is None and not any(a in text for a in self.added)

    def is_loose(self, text: str) -> bool:
        return any(a in text for a in self.loose)

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text and, as pieces of their own, the strings of added tokens."""
        if self.plain(text):
            return PRE_TOKEN.findall(text)
        out = []
        for k, part in enumerate(self.added_pattern.split(text) if self.added_pattern else [text]):
            if k % 2:
                out.append(part)
            elif _OTHER.search(part) is None:
                out += PRE_TOKEN.findall(part)
            else:
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def whole(self, text: str) -> tuple[int, int]:
        """Numbers of ids and of pre-tokens, by the library alone."""
        got = self.tokenizer.encode(text, add_special_tokens=False)
        return len(got.ids), len(set(got.word_ids))

    def ids(self, text: str) -> np.ndarray:
        if self.plain(text):
            return np.frombuffer(b"".join(map(self.memo.__getitem__, PRE_TOKEN.findall(text))), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def count(self, piece: str) -> int:
        """Number of ids of one pre-token."""
        return len(self.memo[piece]) // 4


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; its memory serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
