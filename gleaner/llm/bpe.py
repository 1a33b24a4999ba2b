"""Byte-pair encoding by longest matches with backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the bytes of all tokens finds the longest token at
every place of a word in one pass. A token may follow another only where merging
their joined bytes by rank would end in just these two; that is read off the order
in which the merges built them. So the encoder takes the longest match that the
token before allows, else its longest prefix that is a token, else it steps back
and never tries that place again. Every place is left at most once, so the work
grows with the length of the word, and the ids are those of merging by rank.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.llm.tokens import vocabulary_path

BYTE_BPE = "byte_bpe_50k.json"
#: Fixed value: the pattern that cuts a text into words before bytes are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blocks in which all versions of Unicode agree on letters and numbers. Texts with other characters are cut by the library.
SETTLED = "\\x00-\\u052f\\u2000-\\u206f\\u20a0-\\u20bf\\u3000-\\u30ff\\u4e00-\\u9fff\\uac00-\\ud7a3\\U0001f300-\\U0001f5ff\\U0001f600-\\U0001f64f"
#: Words and pairs of tokens whose result a worker remembers, and ids decoded at once.
WORDS, PAIRS, IDS = 1 << 19, 1 << 20, 1 << 20


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable ones themselves, the others from 256 on in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in kept else next(others)) for b in range(256)]


class Bpe:
    """A byte-level vocabulary: tokens as byte strings, the merge that made each, and the automaton over them."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        byte_of = {char: byte for byte, char in enumerate(byte_alphabet())}
        vocabulary: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = 1 + max(*vocabulary.values(), *added.values())
        self.tokens: list[bytes] = [b""] * size
        for name, token in vocabulary.items():
            self.tokens[token] = bytes(byte_of[c] for c in name)
        for name, token in added.items():
            self.tokens[token] = name.encode()
        #: The rank of the merge that makes a token, -1 for single bytes, and its two parts.
        self.rank = [-1] * size
        self.parts: list[tuple[int, int]] = [(k, k) for k in range(size)]
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            token = vocabulary[left + right]
            pair = vocabulary[left], vocabulary[right]
            self.merged[pair] = rank
            if self.rank[token] < 0:
                self.rank[token], self.parts[token] = rank, pair
        # A byte a character, so that the automaton sees bytes.
        self.automaton = ahocorasick.Automaton()
        for token in vocabulary.values():
            self.automaton.add_word(self.tokens[token].decode("latin-1"), token)
        self.automaton.make_automaton()
        known = {self.tokens[token]: token for token in vocabulary.values()}
        #: The longest token that a token begins with, itself left out; -1 for single bytes.
        self.shorter = [-1] * size
        for token in vocabulary.values():
            own = self.tokens[token]
            self.shorter[token] = next((known[own[:n]] for n in range(len(own) - 1, 0, -1) if own[:n] in known), -1)
        self.size = [len(t) for t in self.tokens]
        self.compatible: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.added = added
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.cut_words: Callable[[str], list[str]] = regex.compile(PATTERN).findall
        self.settled = regex.compile(f"[{SETTLED}]*+\\Z").match
        self.library = Tokenizer.from_file(path)
        self.offsets = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the joined bytes of two tokens are merged into just these two."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            self.compatible[key] = known = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        """Takes the two tokens apart, the part made last first: no merge over the border may come before it was made.

        Of merges of equal rank the left one comes first.
        """
        rank, parts, merged = self.rank, self.parts, self.merged
        over = merged.get((left, right))
        if over is not None:
            return False
        while True:
            if rank[left] > rank[right]:
                made = rank[left]
                left = parts[left][1]
            elif rank[right] >= 0:
                made = rank[right] + 1
                right = parts[right][0]
            else:
                return True
            over = merged.get((left, right))
            if over is not None and over < made:
                return False

    def merge(self, word: bytes) -> list[int]:
        """The ids of a word."""
        n = len(word)
        size = self.size
        longest = [0] * n
        length = [0] * n
        for end, token in self.automaton.iter(word.decode("latin-1")):
            start = end + 1 - size[token]
            if size[token] > length[start]:
                longest[start], length[start] = token, size[token]
        found: list[int] = []
        dead = bytearray(n + 1)
        at = 0
        token = longest[0] if n else -1
        while at < n:
            before = found[-1] if found else -1
            while token >= 0:
                end = at + size[token]
                if not dead[end] and (before < 0 or self.may_follow(before, token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                found.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                dead[at] = 1
                token = found.pop()
                at -= size[token]
                token = self.shorter[token]
        return found

    def word(self, word: str) -> bytes:
        """The ids of a word as little-endian unsigned 32-bit integers; remembered."""
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= WORDS:
                self.words.clear()
            ids = np.array(self.merge(word.encode()), "<u4").tobytes()
            if len(word) <= 64:
                self.words[word] = ids
        return ids

    def cut(self, text: str) -> list[str]:
        """The words of a text without names of added tokens."""
        if self.settled(text) is not None:
            return self.cut_words(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, little-endian; names of added tokens give their ids, null is an empty text."""
        if not text:
            return b""
        if self.cut_added is None or not any(name in text for name in self.added):
            return b"".join(map(self.word, self.cut(text)))
        pieces = []
        for k, piece in enumerate(self.cut_added.split(text)):
            if k % 2:
                pieces.append(np.array([self.added[piece]], "<u4").tobytes())
            elif piece:
                pieces += map(self.word, self.cut(piece))
        return b"".join(pieces)

    def decode(self, ids: bytes) -> Iterator[bytes]:
        """The bytes that ids stand for, in pieces: each id's place in the bytes of all tokens is looked up."""
        numbers = np.frombuffer(ids, "<u4")
        for low in range(0, len(numbers), IDS):
            some = numbers[low : low + IDS]
            starts = self.offsets[some]
            sizes = self.offsets[some + np.uint32(1)] - starts
            ends = np.cumsum(sizes)
            total = int(ends[-1])
            where = np.arange(total) + np.repeat(starts - (ends - sizes), sizes)
            yield self.bytes[where].tobytes()

    def decoded_text(self, ids: bytes) -> str:
        """As the library's decoder: bytes that are no UTF-8 become the replacement character."""
        return b"".join(self.decode(ids)).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """The vocabulary of a file, one per worker process."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def _sha_of(pieces: Iterable[bytes]) -> str:
    """SHA-256 of the text that byte strings decode to, without joining those of a very long text that is plain UTF-8."""
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(decoder.decode(piece).encode())
    digest.update(decoder.decode(b"", True).encode())
    return digest.hexdigest()


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row: the ids of the whole text as little-endian unsigned 32-bit integers."""
    path = path or vocabulary_path(BYTE_BPE)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [own.encode(text.as_py()) for text in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    path = path or vocabulary_path(BYTE_BPE)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(path)
        for batch in batches:
            texts = [own.decoded_text(i.as_py() or b"") for i in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(decode, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, text string")


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Whole texts are encoded, and their ids decoded again, where they lie; nothing
    is shuffled. A null text is an empty one. Reads doc_id and text only.
    """
    path = path or vocabulary_path(BYTE_BPE)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe(path)
        for batch in batches:
            sizes, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py())
                sizes.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(_sha_of(own.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                schema=pa.schema(
                    [batch.schema.field(0), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                ),
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(digested, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
