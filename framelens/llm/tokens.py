"""Whole texts to token ids with a tokenizers file, with a memory of pieces that came before.

A byte-level BPE file of this kind never merges over the start of a white-space run: its pattern lets a token hold
one leading space at most. So a text without two white-space characters in a row before a word can be cut at every
space, each piece can be encoded alone, and the ids of the whole are those of the pieces. A new piece of common
letters is cut by the file's own pattern and each part goes to the file's merges; a piece with other characters, and a
text with white-space runs or a special token's string, is encoded by the tokenizer as a whole. The memory of pieces
is bounded: two generations, of which the older is dropped when the younger is full.
"""

from __future__ import annotations

import os
import re
from struct import Struct

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer, pre_tokenizers

ID_BYTES = 4

#: White space at the end (with U+180E, which some versions count in).
_OPEN = re.compile("[\\s᠎]\\Z")
#: Characters up to U+024F: all Unicode versions agree on which of these are letters, digits and white space.
_COMMON = re.compile("[\x00-ɏ]*")
#: Marks that stand behind a word as a part of their own.
_MARKS = ".,;:!?%*&$#|()[]{}<>=+-_/\\\"@^~`"
_BLANK = " "
#: Stands for the ids of a piece that white space joins to the next.
_RUNS_ON = b""


def _spelling() -> dict[int, str]:
    """What the library's own byte-level step makes of each common character."""
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {code: "".join(part for part, _ in split.pre_tokenize_str(chr(code))) for code in range(0x250)}


_SHAPES = [Struct(f"<{n}I").pack for n in range(64)]


def _packed(ids: list[int]) -> bytes:
    return _SHAPES[len(ids)](*ids) if len(ids) < len(_SHAPES) else np.array(ids, "<u4").tobytes()


class PieceEncoder:
    """Token ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, max_pieces: int = 300_000, max_chars: int = 12_000_000) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.max_pieces, self.max_chars = max_pieces, max_chars
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.spelling = _spelling()
        self.lead = self.spelling[ord(_BLANK)]
        self.memory: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.chars = 0

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return self._whole(text)
        first, *inner = text.split(_BLANK)
        if not inner:
            return self._piece(first)
        last = inner.pop()
        if _OPEN.search(first):
            return self._whole(text)
        memory = self._room()
        found = list(map(memory.get, inner))
        if None in found:
            at = -1
            while True:
                try:
                    at = found.index(None, at + 1)
                except ValueError:
                    break
                found[at] = memory.get(inner[at]) or self._learn(inner[at])
        if _RUNS_ON in found:
            return self._whole(text)
        return self._piece(first) + b"".join(found) + self._piece(_BLANK + last)

    def _room(self) -> dict[str, bytes]:
        """The memory; where it is full it becomes the older one, from which pieces in use are taken over."""
        if len(self.memory) > self.max_pieces or self.chars > self.max_chars:
            self.older, self.memory, self.parts, self.chars = self.memory, {}, {}, 0
        return self.memory

    def rest(self) -> None:
        """Gives up the older memory, so that a worker that waits holds little."""
        self.older = {}

    def _learn(self, piece: str) -> bytes:
        """Puts the ids of an inner piece into the memory; one that is empty or ends in white space has none."""
        ids = self.older.get(piece)
        if ids is None and piece.isascii() and piece.isalpha():
            # The most frequent kind, a plain word.
            ids = _packed([t.id for t in self.model.tokenize(self.lead + piece)])
        elif ids is None:
            core = piece.rstrip(_MARKS)
            if core.isalpha() and (core.isascii() or _COMMON.fullmatch(core)):
                ids = self._word(core)
                if core != piece:
                    ids += self._part(piece[len(core) :])
            else:
                ids = _RUNS_ON if not piece or _OPEN.search(piece) else self._piece(_BLANK + piece)
        self.memory[piece] = ids
        self.chars += len(piece)
        return ids

    def _word(self, word: str) -> bytes:
        """The ids of common letters with a blank before them."""
        ids = self.memory.get(word) or self.older.get(word)
        if ids is None:
            ids = _packed([t.id for t in self.model.tokenize(self.lead + (word if word.isascii() else word.translate(self.spelling)))])
            self.memory[word] = ids
            self.chars += len(word)
        return ids

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        if not _COMMON.fullmatch(piece):
            return self._whole(piece)
        return b"".join([self._part(p) for p in self.pattern.findall(piece)])

    def _part(self, part: str) -> bytes:
        """The ids of what the pattern leaves in one piece; a word with its blank is in the memory of pieces."""
        if part[0] == _BLANK and part[1:].isalpha():
            return self._word(part[1:])
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = _packed([t.id for t in self.model.tokenize(part.translate(self.spelling))])
            self.chars += len(part)
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of this worker process for a file."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
