"""Token ids of whole texts, by the tokenizers library.

A byte-level pre-token holds one word at most, with the space before it.  White space that
stands in front of a word is a pre-token up to its last character; that is the word's own
space, or a pre-token again.  So words are encoded one by one, each different word once, and
put together by numpy.  Texts that hold the string of an added token, such as
`<|endoftext|>`, are encoded by the library as a whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex

from rankspark.llm import words as W

#: Id put after each document.
END = 2
#: Words, and pre-tokens, that a worker remembers; beyond it starts anew.
WORDS = 1_000_000
PRE_TOKENS = 300_000

#: Fixed value: the byte-level pre-tokens, as far as words of Latin letters can hold them.
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+")
_LATIN = re.compile(r"[!-~\xa1-\u024f]+")
#: Fixed value: white space and what Python takes for it, other than that between words.
_SPACES = r"\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_EDGE = re.compile(rf"^[{_SPACES}]|[{_SPACES}]$")
_SPACE, _LINE_FEED = 0x20, 0x0A


def _byte_letters() -> list[str]:
    """Byte-level letters: printable Latin-1 stands for itself, other bytes from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return [chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256)]


_LETTERS = _byte_letters()


class Encoder:
    """A tokenizer file and what it made of the words so far."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        # Those with white space stand in more than one word, so they are looked for in the text.
        spaced = [c.encode() for c in added if re.search(r"\s", c)]
        self.spaced = re.compile(b"|".join(map(re.escape, spaced))) if spaced else None
        self.model = self.tokenizer.model
        self.pre_tokens: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.names = np.zeros(0, np.uint64)  # of the words, in order
        self.entry = np.zeros(0, np.int64)  # which entry each has
        # Entries are stretches of ids: nothing, the end, a line feed, then words and gaps.
        self.ids = np.array([END, *self._whole("\n")], np.uint32)
        self.start = np.array([0, 0, 1], np.int64)
        self.length = np.array([0, 1, len(self.ids) - 1], np.int64)
        self.edge = np.zeros(3, bool)  # words with other white space at an end, or an added token
        self.gaps: dict[bytes, int] = {}

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _alone(self, word: str) -> bool:
        """Whether a text with this word is encoded as a whole."""
        if self.added is not None and self.added.search(word):
            return True
        return not word.isalpha() and _EDGE.search(word) is not None

    def _pre_token(self, letters: str) -> list[int]:
        ids = self.pre_tokens.get(letters)
        if ids is None:
            ids = self.pre_tokens[letters] = [t.id for t in self.model.tokenize(letters)]
        return ids

    def _word(self, word: str, spaced: bool) -> list[int]:
        """The ids of a word, perhaps with a space before it."""
        if word.isascii() and word.isalpha():
            return self._pre_token(_LETTERS[_SPACE] + word if spaced else word)
        text = " " + word if spaced else word
        if not _LATIN.fullmatch(word):
            return self._whole(text)
        out: list[int] = []
        for part in _PRE_TOKEN.findall(text):
            out += self._pre_token("".join([_LETTERS[b] for b in part.encode()]))
        return out

    def _add(self, found: list[list[int]], edge: list[bool]) -> int:
        """New entries; the number of the first."""
        first = len(self.start)
        length = np.array([len(x) for x in found], np.int64)
        flat = array("I")
        for x in found:
            flat.extend(x)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, np.frombuffer(flat, np.uint32)])
        self.edge = np.concatenate([self.edge, np.array(edge, bool)])
        return first

    def _gap(self, gap: bytes, last: bool) -> int:
        """The entry of white space before a word, without the word's own space, or at the end."""
        key = gap + b"\0" if last else gap
        if key not in self.gaps:
            text = gap.decode()
            if last:
                ids = self._whole(text)
            else:
                ids = (self._whole(text[:-1]) if text[:-1] else []) + ([] if text[-1] == " " else self._whole(text[-1]))
            self.gaps[key] = self._add([ids], [False])
        return self.gaps[key]

    def _words(self, c: W.Chunk, spaced: np.ndarray) -> np.ndarray:
        """The entry of each word of the chunk."""
        names = W.mix(c.names() + spaced.astype(np.uint64))
        name, where, back = np.unique(names, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.names, name), max(0, len(self.names) - 1))
        new = self.names[at] != name if len(self.names) else np.ones(len(name), bool)
        if new.any():
            if len(self.pre_tokens) > PRE_TOKENS:
                self.pre_tokens.clear()
            data, k = c.data.tobytes(), where[new]
            bounds = zip(c.start[k].tolist(), c.end[k].tolist(), spaced[k].tolist(), strict=True)
            words = [(data[a:b].decode(), s) for a, b, s in bounds]
            edge = [self._alone(word) for word, _ in words]
            first = self._add([self._word(*word) for word in words], edge)
            place = np.searchsorted(self.names, name[new])
            self.entry = np.insert(self.entry, place, np.arange(first, first + len(words)))
            self.names = np.insert(self.names, place, name[new])
            at = np.searchsorted(self.names, name)
        return self.entry[at][back]

    def _chunk(self, c: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a chunk, and where each text ends."""
        if len(self.names) > WORDS:
            self._forget()
        n = np.diff(c.first)
        doc = np.repeat(np.arange(len(c)), n)
        before = np.empty_like(c.start)  # where the gap before each word begins
        before[1:] = c.end[:-1]
        some = n > 0
        before[c.first[:-1][some]] = c.offset[:-1][some]
        gap = c.start - before
        byte = c.data[c.start - 1] if len(c.data) else np.zeros(0, np.uint8)
        spaced = (gap > 0) & (byte == _SPACE)
        tail = c.offset[1:].copy()
        tail[some] = c.end[c.first[1:][some] - 1]
        tail = np.where(some, c.offset[1:] - tail, 0)
        wide = np.flatnonzero((gap > 1) | ((gap == 1) & ~spaced & (byte != _LINE_FEED)))
        # Units of ids, in order: for each word its gap and itself, for each text its end.
        gaps, words = np.where((gap == 1) & ~spaced, 2, 0), self._words(c, spaced)
        # Where white space may go on within a word, or all is white space, or an added token is
        # named, the text is one unit.
        whole = np.bincount(doc, self.edge[words], len(c)) > 0
        whole |= ~some & (c.offset[1:] > c.offset[:-1])
        if self.spaced is not None:
            whole |= [self.spaced.search(c.text(d)) is not None for d in range(len(c))]
        for k in wide.tolist():
            gaps[k] = self._gap(c.data[before[k] : c.start[k]].tobytes(), False)
        ends = np.zeros(len(c), np.int64)
        for d in np.flatnonzero(tail).tolist():
            ends[d] = self._gap(c.text(d)[-tail[d] :], True)
        kept, alone = (len(self.start), len(self.ids)), np.flatnonzero(whole)
        if len(alone):  # entries for this chunk only
            ends[alone] = self._add([self._whole(c.text(d).decode()) for d in alone], [False] * len(alone))
            ends[alone] += np.arange(len(alone))
            gaps[whole[doc]] = words[whole[doc]] = 0
        unit = np.empty(2 * len(words) + 2 * len(c), np.int64)
        at = 2 * (np.arange(len(words)) + doc)
        unit[at], unit[at + 1] = gaps, words
        close = 2 * (c.first[1:] + np.arange(len(c)))
        unit[close], unit[close + 1] = ends, 1
        length = self.length[unit]
        stop = np.cumsum(length)
        ids = self.ids[np.repeat(self.start[unit] - stop + length, length) + np.arange(stop[-1] if len(stop) else 0)]
        if len(alone):
            self.start, self.length, self.edge = (x[: kept[0]] for x in (self.start, self.length, self.edge))
            self.ids = self.ids[: kept[1]]
        return ids, stop[close + 1]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text and ``END``, as unsigned 32-bit integers; a null text is empty."""
        for c in W.chunks(texts, W.PLAIN):
            ids, stop = self._chunk(c)
            start = 0
            for end in stop.tolist():
                yield ids[start:end]
                start = end


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
