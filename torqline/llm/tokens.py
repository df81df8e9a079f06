"""Token ids of whole texts by the tokenizers library, piece by piece where that gives the same ids.

Both vocabularies split a text into pieces by a pattern before any merge, so the ids of a text are those of its
pieces. Words repeat; a worker keeps the ids of the pieces it has met and asks the library for new ones only.
Texts with characters on which two regular-expression engines could differ, or with the spelling of a special
token, go to the library as a whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

MEMO_PIECES = 400_000  # pieces a worker remembers at most; beyond that it starts afresh
TOGETHER_CHARS = 1 << 18  # characters of texts whose unknown pieces go to the library together
LONG_PIECE = 64  # characters beyond which a piece is not remembered

# Characters for which \s, \p{L}, \p{N}, composition and lower-casing agree everywhere.
_PLAIN = [0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, 0x130), *range(0x131, 0x149), *range(0x14A, 0x180)]


def _chars(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in _PLAIN if unicodedata.category(chr(c))[0] == kind)


_OTHER = re.compile("[^" + "".join(re.escape(chr(c)) for c in _PLAIN) + "]")
_L, _N = _chars("L"), _chars("N")
# The patterns that the two vocabularies were made with.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_LEVEL = re.compile(rf"{_ENDINGS}| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_WORD_LEVEL = re.compile(rf"{_ENDINGS}|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
# Fixed rule: both vocabularies spell a byte as its Latin-1 character where that is visible, the others as the
# characters from U+0100 on, in order.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELLED = {b: 0x100 + n for n, b in enumerate(b for b in range(0x100) if b not in _VISIBLE)}


class _Memo(dict):
    """Pieces and their ids. A piece without ids gets room in ``open``, for ids that come later."""

    def __init__(self):
        self.open: dict[str, bytearray] = {}

    def __missing__(self, piece: str) -> bytearray:
        return self.open.setdefault(piece, bytearray())


class Encoder:
    """Texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words = self.library.normalizer is not None  # lower case, white space dropped
        self.pattern = _WORD_LEVEL if self.words else _BYTE_LEVEL
        added = self.library.get_added_tokens_decoder().values()
        self.openings = {token.content[:2] for token in added}
        self.memo = _Memo()
        self.memo_pieces = memo_pieces
        # Ids that a space followed by letters begins with; such a piece has no other token with a space.
        vocabulary = self.library.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.opens[[n for token, n in vocabulary.items() if token[0] == chr(_SPELLED[0x20])]] = not self.words

    def _ask(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _merged(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of each piece."""
        found, spaced = {}, []
        if self.opens.any():
            # End to end, words that begin with a space are cut into the same pieces again.
            spaced = [piece for piece in pieces if piece[0] == " " and piece[1:].isalpha()]
        if spaced:
            (whole,) = self.library.encode_batch_fast(["".join(spaced)], add_special_tokens=False)
            ids = np.array(whole.ids, dtype="<u4")
            first = np.flatnonzero(self.opens[ids])
            if len(first) == len(spaced) and first[0] == 0:
                raw, cuts = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                found = {piece: raw[i:j] for piece, i, j in zip(spaced, cuts, cuts[1:])}
        merge = self.library.model.tokenize
        for piece in pieces:
            if piece not in found:
                spelled = piece.encode().decode("latin-1").translate(_SPELLED)
                found[piece] = array("I", [token.id for token in merge(spelled)]).tobytes()
        return found

    def _together(self, texts: list[str | None]) -> list[bytes]:
        memo, rows = self.memo, []
        memo.open = {}
        if len(memo) > self.memo_pieces:
            memo.clear()
        for text in texts:
            if not text:
                rows.append([])
            elif _OTHER.search(text) or any(opening in text for opening in self.openings):
                rows.append(self._ask([text]))
            else:
                pieces = self.pattern.findall(text.lower() if self.words else text)
                rows.append(list(map(memo.__getitem__, pieces)))
        if memo.open:
            new = self._merged(list(memo.open))
            for piece, room in memo.open.items():
                room += new[piece]
            memo.update((piece, ids) for piece, ids in new.items() if len(piece) <= LONG_PIECE)
        return [b"".join(row) for row in rows]

    def encode(self, text: str | None) -> bytes:
        return self._together([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; of ``TOGETHER_CHARS`` of texts at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text or "") + 1
            if size >= TOGETHER_CHARS:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, memo_pieces: int = MEMO_PIECES) -> Encoder:
    """The encoder of this worker process; it outlives a task when Spark reuses the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, memo_pieces)
    return _ENCODERS[path]
