"""Token ids of whole texts, shared by packing and the token files."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from tokenizers import Tokenizer

# Characters at which str.split cuts although they are no white space to the tokenizer.
_NOT_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
# Fixed value: the pieces of a word that no token spans.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# A mark behind a letter or digit, before white space or the end: a piece of its own.
_MARK = re.compile(r"([.,])(?=\s|\Z)(?<=[^\W_][.,])")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


class Known(dict):
    """A dictionary that makes what it lacks and forgets everything once it holds ``limit`` entries."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers, by the tokenizers library, word by word.

    For ``word_bpe_49k.json``, which drops white space and lets no token span it: a text's ids are the ids of
    its words in a row. A text of Latin-1 characters needs no normalisation but lower case; its words are cut into
    pieces here and only new pieces go to the library's model. Words of other texts, and texts with special strings,
    go through the whole tokenizer. The limits bound what is kept.
    """

    def __init__(self, file: str, end_id: int | None = None, words: int = 600_000):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        self.known = Known(self._word, words)
        self.others = Known(self._whole, words // 4)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join([self.letters[b] for b in piece.encode()])
        ids = self.bytes
        return b"".join([ids[t.id] for t in self.model.tokenize(piece)])

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self._piece(word)
        if not word.isprintable():
            return self._whole(word)
        return b"".join([self._piece(p) for p in _PIECES.findall(word)])

    def encode(self, text: str | None) -> bytes:
        """The ids of one text, with the end id; a null text is empty."""
        if not text:
            return self.end
        if any(c in text for c in _NOT_SPACE) or any(s in text for s in self.specials):
            return self._whole(text) + self.end
        if text.isascii() or _is_latin(text):
            words, known = _MARK.sub(r" \1", text.lower()).split(), self.known
        else:
            words, known = text.split(), self.others
        return b"".join(map(known.__getitem__, words)) + self.end


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=4)
def word_encoder(file: str, end_id: int | None) -> WordEncoder:
    """One encoder for all tasks of a Python worker, so that words learnt in one serve the next."""
    return WordEncoder(file, end_id)
