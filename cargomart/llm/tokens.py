"""Exact token ids of whole texts with a public tokenizer, a chunk at a time.

A text is cut at white space where the tokenizer's own first splitting can't
reach across, so that each chunk's ids don't depend on its neighbours.  Each
Python worker remembers the ids of chunks it has seen (two bounded
generations, so that common words stay) and asks the library for new ones.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Chunks of one generation (about 160 bytes each); two are held at most.
GENERATION = 200_000
#: Longer chunks are encoded but not remembered.
KEEP_CHARS = 48

#: Separators that Python takes for white space, but not the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")
#: White space beyond single spaces and newlines.
_OTHER = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n\x1c\x1d\x1e\x1f"]
_RUNS = ("  ", "\n\n", " \n", "\n ", *_OTHER)
_RUN = re.compile(r"\s+\S*|\S+")
#: A word of Latin letters and the punctuation after it: the tokenizer's first
#: splitting makes just these two parts of it, and letters of this range have
#: one lower-case form each and are in composed form already.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable letter for each byte: bytes that print stand
    for themselves, the others follow from U+0100 on in ascending order."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in prints)
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class _Known(dict):
    """Ids of chunks; a chunk that is missing is looked up or encoded once."""

    def __init__(self, encode, before):
        self.encode, self.before = encode, before

    def __missing__(self, chunk: str) -> bytes:
        ids = self.before.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        if len(chunk) <= KEEP_CHARS:
            self[chunk] = ids
        return ids


class ChunkEncoder:
    """``keeps_space``: True for byte-level BPE that joins a space to the word
    after it and keeps case, False for vocabularies that drop white space and
    lower-case."""

    def __init__(self, path: str, keeps_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.keeps_space = keeps_space
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.known = _Known(self._encode, {})
        self.tokenize = self.tokenizer.model.tokenize

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.keeps_space:
            # Both characters are white space to the tokenizer, and dropped.
            return text.replace("\n", " ").split(" ")
        if _ODD.search(text):
            return [text]
        if "\0" in text or any(x in text for x in _RUNS):
            return _RUN.findall(text)
        # Only single spaces, which stay in front of the next word, and single
        # newlines, which are parts of their own.
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _encode(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if chunk.isascii() and (chunk if not self.keeps_space else chunk[chunk[0] == " " :]).isalpha():
            return self._word(chunk)
        plain = _PLAIN.fullmatch(chunk)
        if not plain:
            return array(self.code, self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        space, word, marks = plain.groups()
        if self.keeps_space:
            parts = (space + word, marks) if word else (space + marks,)
        else:
            parts = (word.lower(), marks)
        # Parts that are chunks themselves are mostly known.
        return b"".join([self.known[part] if part != chunk else self._word(part) for part in parts if part])

    def _word(self, part: str) -> bytes:
        """Ids of a word, or of punctuation, with the space before it if it has one."""
        if not self.keeps_space:
            part = part.lower()
        if part[0] == " " or not part.isascii():
            part = part.encode().decode("latin-1").translate(_LETTERS)
        return array(self.code, [x.id for x in self.tokenize(part)]).tobytes()

    def encode(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """Ids of each text, and ``end_id`` after them, as arrays of ``self.dtype``."""
        if len(self.known) > GENERATION:
            self.known.before.clear()
            self.known = _Known(self._encode, dict(self.known))
        get = self.known.__getitem__
        end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        return [np.frombuffer(b"".join(map(get, self.chunks(t))) + end, self.dtype) for t in texts]


_ENCODERS: dict[tuple[str, bool], ChunkEncoder] = {}


def encoder(path: str, keeps_space: bool) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file; kept between tasks."""
    # One thread each: Spark runs a worker per core already.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = ChunkEncoder(path, keeps_space)
    return _ENCODERS[path, keeps_space]
