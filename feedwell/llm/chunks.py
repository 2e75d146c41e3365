"""Token ids of texts at the speed that scanning whole corpora needs.

``WordTokens`` looks space-delimited chunks up in a table of what the tokenizer gives for them:
texts repeat their words, and a tokenizer that drops white space reads each chunk alone.
``ByteTokens`` runs a byte-level vocabulary, where spaces belong to words, over whole texts.
Byte-pair merges run through tiktoken, with the ranks of the same vocabulary file. Both give exactly
what the ``tokenizers`` library gives for the whole text: each task compares them on the first chunks
that it meets, and the tests on every kind of character.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: The public pattern that splits text before the merges of byte-level BPE, in the form that the engine's
#: library gives for the same vocabulary: runs give nothing back, so that it splits alike and faster (fixed value).
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Characters of text that are split at once; bounds the Python strings in memory.
SEGMENT = 1 << 20
#: Distinct chunks kept; beyond it the table starts anew.
KEPT = 800_000


class _Index(dict):
    """Number of each chunk; unseen ones get the next number and are noted."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, chunk):
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def ragged(lists: list, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of the lists in order, and how many each list has."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype, int(sizes.sum())), sizes


Encoder = Callable[[list], tuple[np.ndarray, np.ndarray]]
"""Gives, for a list of chunks, all their values in order and how many each has."""


class ChunkTable:
    """The values of each chunk, found once.

    It does not hold its encoder, which may hold the table: a cycle would keep a task's table in
    memory long after the task.
    """

    def __init__(self, dtype=np.uint32):
        self.dtype = dtype
        self._clear()

    def _clear(self) -> None:
        self.index = _Index()
        self.values, self.starts, self.sizes = np.empty(0, self.dtype), np.empty(0, np.int32), np.empty(0, np.int32)

    def rows(self, chunks: list, encode: Encoder) -> tuple[np.ndarray, np.ndarray]:
        """All values of the chunks in order, and how many each chunk has."""
        if len(self.index) > KEPT:
            self._clear()
        at = np.fromiter(map(self.index.__getitem__, chunks), np.int32, len(chunks))
        if self.index.new:
            self._add(encode)
        sizes = self.sizes[at]
        ends = np.cumsum(sizes, dtype=np.int32)
        take = np.repeat(self.starts[at] - (ends - sizes), sizes)
        take += np.arange(len(take), dtype=np.int32)
        return self.values[take], sizes

    def _add(self, encode: Encoder) -> None:
        flat, sizes = encode(self.index.new)
        self.index.new = []
        starts = len(self.values) + np.cumsum(sizes) - sizes
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])
        self.values = np.concatenate([self.values, flat])
        self.sizes = np.concatenate([self.sizes, sizes.astype(np.int32)])


def by_size(rows: Iterable[tuple], text: int, most: int = SEGMENT) -> Iterator[list[tuple]]:
    """Rows in groups of at least one, cut when their texts reach ``most`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text] or "")
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def load_tokenizer(path: str) -> Tokenizer:
    """The tokenizer, with the names of special tokens in a text read as ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


class WordTokens:
    """Ids by a BPE vocabulary with ends of words, after NFC and lower case, that drops white space.

    Merges start from bytes of which the last of a word is marked. The mark is a control character
    here, and a token that ends a word is its bytes and the mark. Chunks with characters outside
    ``PLAIN``, on which libraries of different Unicode versions may differ, go through ``tokenizers``.
    """

    #: End of a word, and of a chunk, in the text given to the engine.
    END, NEXT = "\x01", "\x02"
    #: Latin, Greek and Cyrillic, combining marks, punctuation, kana, Chinese and Korean, assigned since long.
    PLAIN = regex.compile(
        r"[\x03-\u0377\u037b-\u037f\u0384-\u038a\u038e-\u03a1\u03a3-\u0527\u2010-\u205e\u3041-\u3096"
        r"\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*"
    )
    #: How a text falls into words before the merges (fixed value of the vocabulary's file, besides NEXT).
    WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}\x02]+"""
    #: Chunks that a task compares with the library.
    COMPARED = 500

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet, ranks, marks = _byte_alphabet(), {}, {1, 2}
        for token, i in vocabulary.items():
            letters = token.removesuffix("</w>")
            if all(c in alphabet and alphabet[c] not in marks for c in letters):
                ranks[bytes(alphabet[c] for c in letters) + self.END.encode() * (letters != token)] = i
        self.next = max(ranks.values()) + 2
        ranks[self.END.encode()], ranks[self.NEXT.encode()] = self.next - 1, self.next
        self.engine = tiktoken.Encoding(
            "words", pat_str=r"[^\s\x01\x02]+\x01|\x02", mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(self.WORDS)
        self.compared = False
        self.table = ChunkTable()

    def _encode(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        if not self.compared:
            self._compare([c for c in chunks if self.PLAIN.fullmatch(c)][: self.COMPARED])
        if self.PLAIN.fullmatch("".join(chunks)):
            return self._merged(chunks)
        plain = np.fromiter((self.PLAIN.fullmatch(c) is not None for c in chunks), bool, len(chunks))
        fast = self._merged([c for c, p in zip(chunks, plain) if p])
        slow = ragged(self._library([c for c, p in zip(chunks, plain) if not p]), np.uint32)
        sizes = np.empty(len(chunks), np.int64)
        sizes[plain], sizes[~plain] = fast[1], slow[1]
        values, of_plain = np.empty(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
        values[of_plain], values[~of_plain] = fast[0], slow[0]
        return values, sizes

    def _library(self, chunks: list) -> list:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _compare(self, chunks: list) -> None:
        values, sizes = self._merged(chunks)
        expected = ragged(self._library(chunks), np.uint32)
        if not (np.array_equal(values, expected[0]) and np.array_equal(sizes, expected[1])):
            raise ValueError("the vocabulary file is not of the kind that WordTokens reads")
        self.compared = bool(chunks)

    def _merged(self, chunks: list) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        text = unicodedata.normalize("NFC", self.NEXT.join(chunks) + self.NEXT)
        text = text.replace("Σ", "σ").lower()  # lower() alone looks at the letters around a sigma
        ids = self.engine.encode_to_numpy(self.words.sub(r"\g<0>" + self.END, text))
        ends = np.flatnonzero(ids == self.next)
        return ids[ids != self.next], np.diff(ends, prepend=-1) - 1

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; give texts of about SEGMENT characters together."""
        if sum(map(len, texts)) > 4 * SEGMENT:
            return [self._long(t) for t in texts]
        parts = [_folded(t).split(" ") for t in texts]
        values, sizes = self.table.rows(list(chain.from_iterable(parts)), self._encode)
        chunk_ends = np.cumsum(list(map(len, parts)))
        ends = np.concatenate([[0], np.cumsum(sizes)])[chunk_ends]
        return np.split(values, ends[:-1])

    def _long(self, text: str) -> np.ndarray:
        ids, start = [], 0
        while start <= len(text):
            cut = text.find(" ", start + SEGMENT) if len(text) - start > SEGMENT else -1
            cut = len(text) if cut < 0 else cut
            ids.append(self.table.rows(_folded(text[start:cut]).split(" "), self._encode)[0])
            start = cut + 1
        return np.concatenate(ids)


def _folded(text: str) -> str:
    """Text with fewer different chunks and the same ids: lines end like words, and ASCII is in lower case."""
    text = text.replace("\n", " ")
    return text.lower() if text.isascii() else text


class ByteTokens:
    """Ids by a byte-level BPE vocabulary whose ids are the ranks of its merges."""

    #: A special token that is never allowed, so that texts hold it as ordinary text. With none, the engine's search
    #: for special tokens stops at every character, which takes a third of its time.
    UNUSED = "\x00\x00"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec["added_tokens"]}
        letters = {ord(c): chr(b) for c, b in _byte_alphabet().items()}
        self.bytes = {
            i: token.translate(letters).encode("latin-1") for token, i in spec["model"]["vocab"].items() if token not in special
        }
        most = max(self.bytes) + 1
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=BYTE_PATTERN, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={self.UNUSED: most}
        )
        self.ends, self.opens = np.zeros(most, bool), np.zeros(most, bool)
        self.ends[[i for i, b in self.bytes.items() if b.rstrip(b"\"')]").endswith((b".", b"!", b"?")) or b"\n" in b]] = True
        self.opens[[i for i, b in self.bytes.items() if b[:1].isspace()]] = True

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Numbers of ids after which a sentence or line ends, ascending; not after the last."""
        closing = self.ends[ids]
        return np.flatnonzero(closing[:-1] & (self.opens[ids[1:]] | ~closing[1:])) + 1 if len(ids) else ids.astype(np.int64)


def _byte_alphabet() -> dict[str, int]:
    """The public mapping of byte-level BPE: printable bytes stand for themselves, others follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
