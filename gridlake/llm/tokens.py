"""Token ids of whole texts with the tokenizers library; a word that comes again is encoded once."""

from __future__ import annotations

import json
import os
import re
import struct

CACHED_PIECES = {"byte": 450_000, "word": 450_000}  # of each of two generations that one Python worker remembers
LONGEST_PIECE = 64  # characters; longer pieces are encoded anew each time

# Texts of these characters are cut here as the library cuts them; all others go to it whole.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_PLAIN = re.compile(f"[\t\n\r -~\u00a1\u00ab\u00bb\u00bf{_LETTERS}]*")
#: How the two vocabularies cut a text into words, in the order in which they try.
_PIECES = {
    "byte": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s0-9{_LETTERS}]+|\\s+(?!\\S)|\\s+"),
    "word": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+"),
}


#: The settings of a vocabulary that cuts texts in these ways.
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SETTINGS = {
    "byte": (None, _BYTES),
    "word": (
        {
            "type": "Sequence",
            "normalizers": [
                {"type": "NFC"},
                {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"},
            ],
        },
        {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": _WORD_SPLIT}, "behavior": "Removed", "invert": True},
                _BYTES | {"use_regex": False},
            ],
        },
    ),
}


def _byte_symbols() -> dict[int, int]:
    """The character by which byte-level vocabularies write each byte: itself if it prints, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """``encode(text)``: the ids as bytes, little-endian unsigned 32-bit.

    ``by`` says how the vocabulary cuts a text: ``"word"`` for one in lower case that drops white
    space, ``"byte"`` for a byte-level one, where a blank belongs to the word after it. A vocabulary
    whose settings are others encodes whole texts, and nothing is remembered.
    """

    def __init__(self, path: str, by: str, remembered: int | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.lower, self.cut = by == "word", _PIECES[by].findall
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.cuts = (parts["normalizer"], parts["pre_tokenizer"]) == _SETTINGS[by] and all(
            t["content"].startswith("<|") for t in parts["added_tokens"]
        )
        self.known = _Known(self.library.model.tokenize, CACHED_PIECES[by] if remembered is None else remembered)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not self.cuts or "<|" in text or not _PLAIN.fullmatch(text):
            return self.whole(text)
        return b"".join(map(self.known.__getitem__, self.cut(text.lower() if self.lower else text)))


class _Known(dict):
    """Ids of the pieces met since the last generation began; those of the one before are taken over when met.

    A piece in neither goes to the library's model at once: it is a word already, so nothing is left to be cut.
    """

    def __init__(self, tokenize, most: int):
        self.tokenize, self.most, self.before, self.symbols = tokenize, most, {}, _byte_symbols()

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            found = [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.symbols))]
            ids = struct.pack(f"<{len(found)}I", *found)
            if len(piece) > LONGEST_PIECE:
                return ids
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[piece] = ids
        return ids


_encoders: dict[tuple[str, str, int | None], Encoder] = {}


def encoder(path: str, by: str, remembered: int | None = None) -> Encoder:
    """One encoder for each Python worker, which keeps what it knows between tasks."""
    key = path, by, remembered
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def release() -> None:
    """Forget all encoders of this worker and the pieces they remember, for a stage that encodes nothing."""
    _encoders.clear()
