"""Token ids of whole texts through the tokenizers library, in Arrow tasks.

A text is cut where the tokenizer itself always cuts it, and each piece is
encoded by the library once per worker; the ids of a text are the ids of its
pieces in order, as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from .common import WordCache, text_groups


#: White space other than the space and the line end.
OTHER_SPACE = [chr(c) for c in (*range(9, 10), *range(11, 14), *range(0x1c, 0x20), 0x85, 0xa0, 0x1680,
                                *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000)]
ASCII_SPACE = [c for c in OTHER_SPACE if c < "\x80"]


def split_words(text: str) -> list:
    """Cuts for tokenizers that lower-case and drop white space: at spaces and
    line ends.  ASCII text is lower-cased before, so that words meet."""
    if text.isascii():
        text = text.lower()
    return text.replace("\n", " ").split(" ")


def plain_spacing(text: str) -> bool:
    """White space is only single spaces and single line ends between words."""
    return not (any(x in text for x in ("\0", "  ", " \n", "\n ", "\n\n"))
                or text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")
                or any(x in text for x in (ASCII_SPACE if text.isascii() else OTHER_SPACE)))


_BORDER = re.compile(r"(?<=\S)(?=[ \n])|(?<=\S\n)(?=\S)")


def split_spaced(text: str) -> list:
    """Cuts for byte-level tokenizers whose words own the space before them.

    No match of the splitting pattern goes on from a word over the space or
    line end behind it, nor from a single line end between words into the
    next word.  Text of any spacing is cut there; other white space stays with
    the word behind it.
    """
    if not plain_spacing(text):
        return _BORDER.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


def id_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


#: One run without white space, a single space before it at most.
one_word = re.compile(r" ?\S+").fullmatch


class LibraryEncoder:
    """Whole texts -> id bytes with a tokenizers file.

    ``cut`` cuts texts into pieces that encode on their own.  Pieces go to the
    library joined by ``mark``, whose one id cannot come from such a piece, so
    that one call encodes ``joined`` of them; other pieces go one by one.
    Texts are taken up in groups of about ``chars`` characters, whose words stay
    in the processor's cache between look-up and joining.  A letter and a
    comma or full stop after it never share a token, so a word that was met
    before without its stop needs no call.
    """

    def __init__(self, path: str, cut, mark: str, joinable, joined: int = 1000,
                 chars: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.cut, self.mark, self.joinable = cut, mark, joinable
        self.joined, self.chars = joined, chars
        self.mark_id, = self.tok.encode(mark, add_special_tokens=False).ids
        self.stops = dict(zip(",.", [x.tobytes() for x in self._ids([",", "."])]))
        self.cache = WordCache(self._encode)

    def _ids(self, texts: list) -> list:
        return [np.array(e.ids, dtype="<u4") for e in
                self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, words: list) -> list:
        out: list = [b""] * len(words)
        join, alone, known = [], [], self.cache.new
        for i, w in enumerate(words):
            if w[-1:] in self.stops and w[-2:-1].isalpha() and w[:-1] in known:
                out[i] = known[w[:-1]] + self.stops[w[-1]]  # a word met without its stop
            elif self.joinable(w):
                join.append(i)
            else:
                alone.append(i)
        for i, ids in zip(alone, self._ids([words[i] for i in alone])):
            out[i] = ids.tobytes()
        parts = [join[a:a + self.joined] for a in range(0, len(join), self.joined)]
        made = self._ids([self.mark.join([words[i] for i in part]) for part in parts])
        for part, ids in zip(parts, made):
            ends = [*(np.flatnonzero(ids == self.mark_id) * 4).tolist(), 4 * len(ids)]
            assert len(ends) == len(part)
            raw, start = ids.tobytes(), 0
            for i, end in zip(part, ends):
                out[i] = raw[start:end]
                start = end + 4
        return out

    def encode(self, texts: list):
        """Id bytes of each text (None counts as empty), lazily, in order."""
        texts = [t or "" for t in texts]
        for a, b in text_groups(texts, self.chars):
            pieces = [self.cut(t) for t in texts[a:b]]
            get = self.cache.lookup(pieces)
            for p in pieces:
                yield b"".join(map(get, p))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> LibraryEncoder:
    """This worker's encoder for a word-level BPE that drops white space."""
    return LibraryEncoder(path, split_words, " \0 ", lambda w: "\0" not in w)


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> LibraryEncoder:
    """This worker's encoder for a byte-level BPE."""
    return LibraryEncoder(path, split_spaced, "\n", one_word, joined=50, chars=100_000)
