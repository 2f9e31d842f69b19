"""Encoding whole texts with a byte-level tokenizers file, words remembered.

A byte-level tokenizer always cuts before a single blank that stands between two
characters that are no white space, and around a single line end between two
such characters. The pieces between such places are encoded on their own, by the
file's own model, and frequent pieces are remembered. A piece of letters, with
or without one mark after it, goes straight to the model; any other goes through
the whole tokenizer.
"""

from __future__ import annotations

import functools
import json
import string
import sys
from array import array

import numpy as np

#: Pieces remembered by a worker in each of two generations.
REMEMBERED = 400_000
#: Longer pieces are not remembered, so what a worker remembers has a bound in bytes.
LONGEST = 64
_MARKS = frozenset(string.punctuation)
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]


def _byte_characters() -> dict[int, str]:
    """Byte-level alphabets write a byte that prints as itself, any other by the
    next free code point from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


_CHARACTERS = _byte_characters()


class Encoder:
    """Ids of texts under one tokenizers file, special tokens not added."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        cuts = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            cuts.get("type") == "ByteLevel"
            and cuts.get("use_regex", True)
            and not cuts.get("add_prefix_space", True)
            and not parts.get("normalizer")
            and not any(
                t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"])
                for t in parts.get("added_tokens", ())
            )
        )
        # an added token may be found in a piece of letters only if it has such
        plain = [t["content"].strip(string.punctuation) == t["content"] for t in parts.get("added_tokens", ())]
        self.by_model = self.by_piece and not any(plain) and parts["model"].get("type") == "BPE"

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text as little-endian numbers of `dtype`."""
        if not text:
            return b""
        if not self.by_piece:
            return self._whole(text)
        if len(self.recent) > REMEMBERED:
            self.older, self.recent = self.recent, {}
        first, rest = pieces(text)
        recent = self.recent
        # remembered without the blank they start with
        found = list(map(recent.get, rest))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self._after_blank(rest[k])
        return self._lines(first) + b"".join(found)

    def _after_blank(self, part: str) -> bytes:
        """The ids of a blank and part, remembered."""
        ids = self.recent.get(part) or self.older.get(part)
        if ids is None:
            # a mark after a word is cut off, so the word may be known without it
            if self.by_model and part[-1:] in _MARKS and part[:-1].isalpha():
                ids = self._after_blank(part[:-1]) + self._bare(part[-1])
            else:
                ids = self._lines(" " + part)
        if len(part) <= LONGEST:
            self.recent[part] = ids
        return ids

    def _bare(self, piece: str) -> bytes:
        """The ids of a piece that follows no blank, remembered."""
        ids = self.bare.get(piece)
        if ids is None:
            if len(self.bare) > REMEMBERED:
                self.bare.clear()
            ids = self._piece(piece)
            if len(piece) <= LONGEST:
                self.bare[piece] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, self.dtype).tobytes()

    def _lines(self, piece: str) -> bytes:
        if not piece:
            return b""
        if "\n" not in piece or not self.by_model:
            return self._piece(piece)
        lines = piece.split("\n")
        body = [lines[0].removeprefix(" "), *lines[1:]]
        if any(not x or x[0].isspace() or x[-1].isspace() for x in body):
            return self._whole(piece)
        head = self._after_blank(body[0]) if piece[0] == " " else self._bare(body[0])
        return self._bare("\n").join([head, *map(self._bare, lines[1:])])

    def _piece(self, piece: str) -> bytes:
        if self.by_model:
            word = piece[1:] if piece[0] == " " else piece
            if word.isalpha():
                return self._model(piece)
            if word[:-1].isalpha() and word[-1] in _MARKS:
                return self._model(piece[:-1]) + self._model(piece[-1])
        return self._whole(piece)

    def _model(self, piece: str) -> bytes:
        word = piece[1:] if piece[0] == " " else piece
        if word.isascii():
            line = _CHARACTERS[0x20] + word if piece[0] == " " else word
        else:
            line = "".join([_CHARACTERS[b] for b in piece.encode()])
        ids = array(self.code, [t.id for t in self.tokenizer.model.tokenize(line)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def pieces(text: str) -> tuple[str, list[str]]:
    """The text cut at single blanks between characters that are no white space:
    what comes before the first, and what follows each."""
    parts = text.split(" ")
    beside = any(c in text and (c + " " in text or " " + c in text) for c in _SPACES)
    if parts[0] and parts[-1] and not beside:
        return parts[0], parts[1:]
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if before and part and not before[-1].isspace() and not part[0].isspace():
            out.append(part)
        else:
            out[-1] += " " + part
    return out[0], out[1:]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
