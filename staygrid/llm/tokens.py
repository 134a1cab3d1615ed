"""Exact tokenization of whole texts by encoding each distinct piece once.

A text of common letters is cut into the pre-tokenizer's own pieces, and each piece goes to the
library's BPE model once. Texts with anything else are cut where a pre-tokenizer always cuts,
before white space that follows something else, and parts that aren't common take the library's
whole path. So do texts that hold a special token's string, which the library reads as that token,
and all texts of a tokenizer file whose normaliser or pre-tokenizer isn't one of those known here.
A bounded cache keeps the ids of pieces; it changes no result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import public_tokenizers
from tokenizers import Tokenizer

#: Texts that normalisation leaves alone but for case: ASCII and precomposed Latin letters.
_LATIN = "a-zA-ZÀ-ÖØ-öø-įı-ſ"
_COMMON = re.compile(rf"[\t-\r\x20-\x7e×÷{_LATIN}]*")
#: What the tokenizer files' patterns cut, over common texts (letters first, which is faster to try).
_FAST_WORDS = re.compile(rf"[{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r 0-9{_LATIN}]+")
_FAST_BYTES = re.compile(rf" ?[{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\t-\r 0-9{_LATIN}]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
# The normalisers and pre-tokenizers that the two patterns above spell out.
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN = {
    False: (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}),
    True: (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": _WORD_RULE}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    ),
}
#: Where any text may be cut: before a blank or newline that follows something that isn't white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: Pieces that a worker's cache may hold.
CACHE = 250_000


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is."""
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte that isn't printable."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


class _Cache(dict):
    """A dictionary that makes what it lacks."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        self[key] = value = self.make(key)
        return value


class ChunkEncoder:
    """Ids of texts as little-endian unsigned integers of `width` bytes (2 or 4).

    They are the ids of the library's `encode(text, add_special_tokens=False)`. `words`: the
    tokenizer lower-cases and ignores white space.
    """

    def __init__(self, path: str, width: int = 4, words: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.words = words
        spelt = json.loads(self.tokenizer.to_str())
        self.known_rules = (spelt.get("normalizer"), spelt.get("pre_tokenizer")) == _KNOWN[words] and spelt["model"]["type"] == "BPE"
        self.special = [t["content"] for t in spelt.get("added_tokens", [])]
        self.known_rules &= not any(t["normalized"] for t in spelt.get("added_tokens", []))
        self.packed = [i.to_bytes(width, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = (_FAST_WORDS if words else _FAST_BYTES).findall
        self.letters = _byte_letters()
        self.known = _Cache(self._piece)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and (piece.isalnum() or piece[0] == " " and piece[1:].isalnum()):
            spelt = piece.replace(" ", "\u0120")  # the letter for a blank
        else:
            spelt = piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.model.tokenize(spelt)])

    def _common(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces(text.lower() if self.words else text)))

    def _whole(self, text: str) -> bytes:
        return b"".join([self.packed[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def _one(self, text: str) -> bytes:
        if not self.known_rules or any(s in text for s in self.special):
            return self._whole(text)
        if text.isascii() or _COMMON.fullmatch(text):
            return self._common(text)
        return b"".join([self._common(part) if _COMMON.fullmatch(part) else self._whole(part) for part in _CUT.split(text)])

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """One bytes object for each text (null: empty)."""
        if len(self.known) > CACHE:
            self.known.clear()
        return [self._one(text) if text else b"" for text in texts]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, width: int, words: bool) -> ChunkEncoder:
    """This worker's encoder, kept from task to task."""
    key = (path, width, words)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, width, words)
    return _ENCODERS[key]
