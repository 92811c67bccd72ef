"""Token ids of whole texts, in tasks: a table of known words in front of the tokenizers library."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Words whose ids a worker remembers; the table is emptied when it is full.
MEMORY = 400_000
END = 0
# White space other than single spaces and line ends between words; texts with any take the plain way.
_ODD_SPACE = [
    *("  ", "\n\n", " \n", "\n "), *map(chr, (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680)), *map(chr, range(0x2000, 0x200B)),
    *map(chr, (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)),
]
# The byte-level pre-tokenizer's pattern, a fixed public value.
_PIECES = regex.compile(r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_worker: dict = {}


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids as little-endian unsigned 16- or 32-bit bytes, for a byte-level BPE file."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Tokens that the file adds stand for themselves in a text; the library finds them.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 2**16 else np.dtype("<u4")
        self.model = self.tokenizer.model
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.memory = memory
        shape = json.loads(self.tokenizer.to_str())
        steps = shape["pre_tokenizer"] or {}
        self.by_bytes = steps.get("type") == "ByteLevel" and steps["use_regex"] and not (steps["add_prefix_space"] or shape["normalizer"])
        self.bytes = {b: ord(c) for b, c in enumerate(_byte_letters())}
        self.end = np.array([END], self.dtype).tobytes()

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text and the end id."""
        plain = lambda t: not any(o in t for o in _ODD_SPACE) and not any(a in t for a in self.added)
        cut = [self._words(t) if t and self.by_bytes and plain(t) else None for t in texts]
        seen = {p for parts in cut if parts for p in parts}
        new = seen.difference(self.known)
        if len(self.known) + len(new) > self.memory:
            self.known, self.pieces, new = {}, {}, seen
        for p in new:
            self.known[p] = self._word(p)
        known, out = self.known.__getitem__, []
        for text, parts in zip(texts, cut):
            ids = b"".join(map(known, parts)) if parts is not None else self._whole(text) if text else b""
            out.append(np.frombuffer(ids + self.end, self.dtype))
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    @staticmethod
    def _words(text: str) -> list[str]:
        """Words between spaces. A line's first word carries the line end before it, the text's
        first word a mark that no space stands before it."""
        words = text.replace("\n", " \n").split(" ")
        words[0] = "\r" + words[0]
        return words

    def _word(self, word: str) -> bytes:
        if word[:1] == "\n":
            return self._ids("\n") + self._word("\r" + word[1:])
        bare = word[1:] if word[:1] == "\r" else " " + word
        letters = word[1:] if word[:1] == "\r" else word
        if letters.isalpha():  # remembered under its word, so not as a piece besides
            return self.pieces.get(bare) or self._new_ids(bare)
        if letters[-1:] in (".", ",") and letters[:-1].isalpha():
            return (self.known.get(word[:-1]) or self._ids(bare[:-1])) + self._ids(bare[-1])
        return b"".join(map(self._ids, _PIECES.findall(bare)))

    def _ids(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = self._new_ids(piece)
        return ids

    def _new_ids(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(self.bytes)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: itself when it can be seen, else the next free one."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return [chr(b) if b in seen else chr(256 + rest.index(b)) for b in range(256)]


def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    if path not in _worker:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _worker.clear()
        _worker[path] = Encoder(path)
    return _worker[path]


def in_lots(texts: pa.Array, chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``chars`` characters together, so that memory stays bounded: a caller makes
    strings of one range at a time."""
    start = size = 0
    for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
        size += n or 0
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
