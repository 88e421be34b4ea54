"""Byte-level BPE ids by the `tokenizers` library, each distinct word encoded once per worker.

The tokenizer splits a text before its merges. A single space or line break between two
characters that are no white space always starts a new piece, so a text can be cut there
and the ids of its words be joined. Texts with any other white space are cut only where
that is sure to hold. Words are split off, told apart, looked up and put together again in
Arrow, many texts at once: only a word that is new to the worker is ever a Python object.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from storepulse.llm.worker import keep

_CUT = re.compile(r"(?<=\S)(?= \S)")
#: White space other than spaces and line breaks, of which each may stand between two words.
_ODD = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_TWO = ("  ", " \n", "\n ", "\n\n")
#: How byte-level tokens write the bytes of a space and a line break, the number of words encoded as one
#: line, and of lines encoded at a time: what the tokenizer gives back takes far more than the ids.
_BETWEEN, _LINE = ("\u0120", "\u010a"), 64
#: Bytes of texts whose words are looked up together, and words whose ids are gathered at a time.
_GROUP, _GATHER = 8 << 20, 1 << 16


def _even(text: str) -> bool:
    """Whether all white space is single spaces and line breaks between words."""
    if text[0] in " \n" or text[-1] in " \n":
        return False
    for found in _TWO:
        if found in text:
            return False
    for found in _ODD:
        if found in text:
            return False
    return True


def _cut(data: bytes, ends: Iterable[int]) -> list[bytes]:
    """Parts of a row of 32-bit ids, each up to one of `ends`."""
    out, begin = [], 0
    for end in ends:
        out.append(data[begin:4 * end])
        begin = 4 * end
    return out


def _binary(data: bytes, sizes: np.ndarray) -> pa.Array:
    """Values of so many bytes each."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _content(values: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all values, and of how many bytes each is."""
    if not len(values):  # there may be no buffers
        return memoryview(b""), np.zeros(0, np.int64)
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    return memoryview(data or b"")[ends[0]:ends[-1]], np.diff(ends)


class _Words:
    """Different words and their ids, without an object for each."""

    def __init__(self):
        self._words, self._ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def __len__(self) -> int:
        return len(self._words)

    def items(self) -> Iterator[tuple[str, bytes]]:
        return zip(self._words.to_pylist(), self._ids.to_pylist())

    def add(self, words: pa.Array, ids: pa.Array) -> np.ndarray:
        """Their places."""
        places = np.arange(len(self), len(self) + len(words))
        self._words, self._ids = pa.concat_arrays([self._words, words]), pa.concat_arrays([self._ids, ids])
        return places

    def places(self, words: pa.Array) -> np.ndarray:
        """Where different words are held; -1: not here. What is held is searched for among `words`, which are fewer."""
        found, places = pc.index_in(self._words, value_set=words), np.full(len(words), -1)
        places[found.drop_null().to_numpy()] = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        return places

    def ids(self, places: np.ndarray) -> pa.Array:
        return self._ids.take(pa.array(places))


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    `memory` bounds the bytes that remembered words take, however long they are. Half of it
    holds the words used of late; when that is full they become the older ones, and the older
    ones that were not used meanwhile are forgotten, which costs time and changes no result.
    """

    def __init__(self, path: str, memory: int = 400_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self._begins[[i for token, i in vocabulary.items() if token.startswith(_BETWEEN)]] = True
        self._memory, self._held, self._known, self._older = memory, 0, _Words(), _Words()

    def _each(self, pieces: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)  # ids only, no offsets
        ids = [e.ids for e in found]
        return _cut(array("I", chain.from_iterable(ids)).tobytes(), accumulate(map(len, ids)))

    def _plain(self, pieces: list[str]) -> pa.Array:
        """Ids of words, each with the space or line break before it, encoded as lines of many.

        Both start a piece, and no piece holds another one, so a word's ids begin where a
        token begins with either. Lines that do not show as many beginnings are not trusted."""
        lines = [pieces[at:at + _LINE] for at in range(0, len(pieces), _LINE)]
        groups = (list(map("".join, lines[at:at + _LINE])) for at in range(0, len(lines), _LINE))
        found = (e.ids for g in groups for e in self._tokenizer.encode_batch_fast(g, add_special_tokens=False))
        data, sizes = [], []
        for line, some in zip(lines, found):
            ids = np.array(some, dtype="<u4")
            begins = np.flatnonzero(self._begins[ids])
            if len(begins) == len(line) and begins[0] == 0:
                data.append(ids.tobytes())
                sizes += [4 * n for n in np.diff(begins, append=len(ids)).tolist()]
            else:
                each = self._each(line)
                data += each
                sizes += map(len, each)
        return _binary(b"".join(data), np.array(sizes, np.int64))

    @staticmethod
    def _size(word: str, ids: bytes) -> int:
        """About what a word and its ids take: their content, twice while words are added, and places."""
        return 72 + 2 * len(word.encode()) + 2 * len(ids)

    def _keep(self, words: pa.Array, ids: pa.Array) -> np.ndarray:
        """Remember words and count their sizes; their places."""
        self._held += 72 * len(words) + 2 * (len(_content(words)[0]) + len(_content(ids)[0]))
        return self._known.add(words, ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as empty."""
        return list(self.stream(pa.array(texts, pa.large_string())))

    def stream(self, texts: pa.Array) -> Iterator[bytes]:
        """The same for an Arrow column, by groups of about `_GROUP` bytes of texts."""
        texts, begin = texts.cast(pa.large_string()), 0
        grown = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
        while begin < len(texts):
            limit = _GROUP + (grown[begin - 1] if begin else 0)
            end = max(begin + 1, int(np.searchsorted(grown, limit, "right")))
            yield from self._group(texts.slice(begin, end - begin))
            begin = end

    def _group(self, texts: pa.Array) -> list[bytes]:
        """A word is looked up once however often the texts hold it, and ids are gathered from there."""
        if self._held > self._memory // 2:
            self._older, self._known, self._held = self._known, _Words(), 0
        rows = texts.to_numpy(zero_copy_only=False).tolist()
        even = [bool(t) and _even(t) for t in rows]
        if not any(even):
            return [self._each_cut(t) for t in rows]
        if not all(even):
            texts = texts.filter(pa.array(even))
        # As if a line break came before the text: its one id is taken off again.
        first, none = pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string())
        spaced = pc.binary_join_element_wise(first, pc.replace_substring(texts, "\n", " \n"), none)
        chunks = pc.split_pattern(spaced, " ")
        begins = chunks.offsets.to_numpy()
        coded = chunks.flatten().dictionary_encode()
        index = self._look_up(coded.dictionary)[coded.indices.to_numpy()]
        ids, ends = self._gathered(index, begins)
        parts = iter([ids[a + 4:b] for a, b in zip([0, *ends], ends)])
        return [next(parts) if e else self._each_cut(t) for t, e in zip(rows, even)]

    def _each_cut(self, text: str | None) -> bytes:
        return b"".join(self._each(_CUT.split(text))) if text else b""

    def _look_up(self, words: pa.Array) -> np.ndarray:
        """Places of different words among the known ones; those not there are taken over from the older ones or learned."""
        places = self._known.places(words)
        for source in (self._recall, self._learn):
            missing = np.flatnonzero(places < 0)
            if len(missing):
                places[missing] = source(words.take(pa.array(missing)))
        return places

    def _recall(self, words: pa.Array) -> np.ndarray:
        """Take words over from the older ones; -1 for those that are not among them."""
        places = self._older.places(words)
        held = places >= 0
        places[held] = self._keep(words.filter(pa.array(held)), self._older.ids(places[held]))
        return places

    def _learn(self, words: pa.Array) -> np.ndarray:
        """A word follows a space that is not written in it, or begins with the line break it follows."""
        new = words.to_numpy(zero_copy_only=False).tolist()
        return self._keep(words, self._plain([w if w[0] == "\n" else " " + w for w in new]))

    def _gathered(self, index: np.ndarray, begins: np.ndarray) -> tuple[bytes, list[int]]:
        """Ids of all words of `index`, places among the known ones, and where those of every text end;
        texts lie between `begins`."""
        upto, parts = np.zeros(len(index) + 1, np.int64), []
        for at in range(0, len(index), _GATHER):
            data, sizes = _content(self._known.ids(index[at:at + _GATHER]))
            upto[at + 1:at + 1 + len(sizes)] = sizes
            parts.append(data)
        return b"".join(parts), np.cumsum(upto)[begins[1:]].tolist()


def encoder(path: str, **bounds: int) -> WordEncoder:
    """One encoder per Python worker, kept for its later tasks with the same file and bounds."""
    return keep((WordEncoder, path, *sorted(bounds.items())), lambda: WordEncoder(path, **bounds))
