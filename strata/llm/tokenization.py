"""Token ids from a public tokenizer file, encoded piece by piece.

The two supported pre-tokenizers never let a token cross the gap before a
space that follows a visible character, so a text is cut there, each distinct
piece is encoded once by the ``tokenizers`` library and remembered, and the
pieces' ids are concatenated.  Byte-level tokenizers write a line feed between
visible characters as a token of its own, so texts are cut around it too.  The
ids are those of the whole text.  The memory of pieces is bounded and only saves
time; a piece is remembered when it is met a second time, so that the many
pieces of a single text don't fill it.
"""

from __future__ import annotations

import functools
import os
import re
import string
from array import array
from collections.abc import Iterator

import numpy as np

MEMORY_PIECES = 400_000
#: Marks of pieces met once, by hash (two pieces may share one); a power of two.
MET_SPOTS = 1 << 22

BATCH_CHARS = 1_000_000

_SAFE_GAP = re.compile(r"(?<=[\w!-~])(?= )")
_OTHER_GAP = re.compile(r" (?<=[^\w!-~] )")
_OTHER_LINE = re.compile(r"\n(?:(?<=[^\w!-~]\n)|(?=[^\w!-~]))")
_ASCII_GAPS = ("  ", "\n ", "\t ", "\r ", "\x0b ", "\x0c ")
#: Marks that end a token where a letter or digit stands before them.
_MARKS = ".,!?;:"
#: Signs of which a run after a letter or digit is one word of byte-level tokenizers.
_SIGNS = ".,!?;:#$%&*+=@^~"
_ALNUM = frozenset(string.ascii_letters + string.digits)
#: The same with the letters of Latin-1.
_LATIN_ALNUM = _ALNUM | {c for c in map(chr, range(128, 256)) if c.isalpha()}
MEMORY_RUNS = 10_000


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable
    bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + n) for n, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()
_SPACE_LETTER = _BYTE_LETTERS[ord(" ")]
#: What byte-level vocabularies write for each character of Latin-1.
_LATIN_LETTERS = {n: "".join(_BYTE_LETTERS.get(b, chr(b)) for b in chr(n).encode()) for n in range(256)}


class PieceEncoder:
    """``keep_spaces``: a piece begins with the space before it (byte-level
    tokenizers); otherwise spaces and line feeds carry no token and are cut out
    (tokenizers that drop white space)."""

    def __init__(self, path: str, keep_spaces: bool, dtype: str = "<u2"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep_spaces, self.dtype = keep_spaces, np.dtype(dtype)
        if self.tokenizer.get_vocab_size() > np.iinfo(self.dtype).max + 1:
            raise ValueError(f"ids of {path} do not fit {dtype}")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.memory: dict[str, bytes] = {"": b""}
        self.met = bytearray(MET_SPOTS)
        self.tokenize = self.tokenizer.model.tokenize
        self.runs: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if not self.keep_spaces:
            return text.replace("\n", " ").split(" ")
        odd = any(g in text for g in _ASCII_GAPS) if text.isascii() else _OTHER_GAP.search(text)
        if odd or "\0" in text:
            return _SAFE_GAP.split(text)
        if "\n" in text and not _OTHER_LINE.search(text):
            text = text.replace("\n", "\0\n\0")
        return text.replace(" ", "\0 ").split("\0")

    def _word(self, piece: str) -> bytes | None:
        """Ids of a piece that is one word of Latin letters: the pre-tokenizer
        leaves it whole, so the library's model takes it as it is."""
        word = piece[1:] if self.keep_spaces and piece[0] == " " else piece
        if not word.isalpha() or not (word.isascii() or max(word) <= "\xff"):
            return None
        if not self.keep_spaces:
            piece = piece.lower()
            if not piece.isascii():
                piece = piece.translate(_LATIN_LETTERS)
        else:
            if not word.isascii():
                word = word.translate(_LATIN_LETTERS)
            piece = word if piece[0] != " " else _SPACE_LETTER + word
        return array(self.code, [t.id for t in self.tokenize(piece)]).tobytes()

    def _stem(self, piece: str) -> str:
        """The piece without what ends it: a mark after an ASCII letter or digit
        is a token of its own; byte-level tokenizers part any run of signs from
        a letter or digit."""
        if self.keep_spaces:
            stem = piece.rstrip(_SIGNS)
            return stem if stem and stem[-1] in _LATIN_ALNUM else piece
        return piece[:-1] if piece[-1] in _MARKS and piece[-2:-1] in _ALNUM else piece

    def _run(self, run: str) -> bytes:
        """Ids of a run of signs."""
        ids = self.runs.get(run)
        if ids is None:
            ids = array(self.code, self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()
            if len(self.runs) < MEMORY_RUNS:
                self.runs[run] = ids
        return ids

    def _look_up(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of pieces that aren't in memory."""
        memory, met, out, rest = self.memory, self.met, {}, []
        for p in missing:
            stem = self._stem(p)
            ids = memory.get(stem) or self._word(stem)
            if ids is None:
                rest.append(p)
            else:
                out[p] = ids if len(stem) == len(p) else ids + self._run(p[len(stem) :])
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            out.update(zip(part, [array(self.code, e.ids).tobytes() for e in found]))
        if len(memory) < MEMORY_PIECES:  # full: the frequent pieces are long since in it
            for p, ids in out.items():
                spot = hash(p) & MET_SPOTS - 1
                if met[spot]:
                    memory[p] = ids
                else:
                    met[spot] = 1
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian integers of ``dtype``."""
        split = [self.pieces(t) for t in texts]
        known = [list(map(self.memory.get, pieces)) for pieces in split]
        gaps = [[i for i, ids in enumerate(k) if ids is None] if None in k else [] for k in known]
        missing = {pieces[i] for pieces, at in zip(split, gaps) for i in at}
        if missing:
            fresh = self._look_up(missing)
            for pieces, k, at in zip(split, known, gaps):
                for i in at:
                    k[i] = fresh[pieces[i]]
        return [b"".join(k) for k in known]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_rows(self, rows: Iterator[tuple]) -> Iterator[tuple]:
        """``(..., text)`` rows as ``(..., ids)`` rows, some texts at a time."""
        held, chars = [], 0
        for row in rows:
            held.append(row)
            chars += len(row[-1] or "")
            if chars >= BATCH_CHARS or len(held) >= 1000:
                yield from self._encode_held(held)
                held, chars = [], 0
        if held:
            yield from self._encode_held(held)

    def _encode_held(self, held: list[tuple]) -> Iterator[tuple]:
        for row, ids in zip(held, self.encode_many([r[-1] or "" for r in held])):
            yield (*row[:-1], ids)

    def widen(self, ids: bytes) -> np.ndarray:
        """The ids as little-endian unsigned 32-bit integers."""
        return np.frombuffer(ids, dtype=self.dtype).astype("<u4")


@functools.lru_cache(maxsize=2)
def shared_encoder(path: str, keep_spaces: bool, dtype: str = "<u2") -> PieceEncoder:
    """One encoder a worker process, with its memory, for all tasks it runs."""
    return PieceEncoder(path, keep_spaces, dtype)
