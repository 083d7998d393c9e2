"""Token ids by the tokenizers library, with the ids of words seen before kept at hand."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

# The split pattern of the word-level vocabulary file that the fast path knows.
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same pattern over printable ASCII and the Latin-1 letters, lower case.
_LATIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^0-9a-zß-öø-ÿ]+")
_LATIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_KEPT_LENGTH = 64


class WordIds:
    """The ids of texts as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.encode``.

    For a tokenizer whose pre-tokenizer drops white space no token spans a blank, so the ids of
    a text are those of its chunks between blanks, one after the other. A chunk met before in the
    task is looked up. A new chunk of printable ASCII and Latin-1 letters is lower-cased, split
    and given to the library's model; any other chunk, and any that might hold a special token,
    goes through the whole tokenizer. At most ``room`` chunks are kept; then they are forgotten.
    Other tokenizers encode whole texts.
    """

    def __init__(self, path: str, room: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.by_chunk = _WORD_SPLIT in str(self.tokenizer.pre_tokenizer).replace("\\\\", "\\")
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.visible = {c: level.pre_tokenize_str(chr(c))[0][0] for c in (*range(0x21, 0x7F), *range(0xC0, 0x100))}
        self.model = self.tokenizer.model
        self.pieces = _Kept(self._piece, room)
        self.chunks = _Kept(self._chunk, room)

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self.pieces[chunk.lower()]
        if not _LATIN.fullmatch(chunk) or "<|" in chunk:
            return self.whole(chunk)
        return b"".join(map(self.pieces.__getitem__, _LATIN_SPLIT.findall(chunk.lower())))

    def _piece(self, piece: str) -> bytes:
        tokens = self.model.tokenize(piece if piece.isascii() else piece.translate(self.visible))
        return _packed([token.id for token in tokens])

    def __call__(self, text: str) -> bytes:
        if not self.by_chunk:
            return self.whole(text)
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


class _Kept(dict):
    """Results of a function of short strings, forgotten all at once when there are too many."""

    def __init__(self, make: Callable[[str], bytes], room: int):
        super().__init__({"": b""})
        self.make, self.room = make, room

    def __missing__(self, text: str) -> bytes:
        ids = self.make(text)
        if len(text) <= _KEPT_LENGTH:
            if len(self) >= self.room:
                self.clear()
                self[""] = b""
            self[text] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if packed.itemsize != 4:
        raise OverflowError("this platform's unsigned int is not four bytes")
    return packed.tobytes()
