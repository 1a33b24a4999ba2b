"""Token ids of whole texts by a public tokenizer file, with a bounded memory of what was encoded before.

Both files' pre-tokenizers cut a text before white space and between letters and
what is neither letter, mark nor white space, and encode what lies between on its
own. So the ids of such parts in a row are the ids of the text, and as prose
repeats its words, most parts can be looked up.
"""

from __future__ import annotations

import itertools
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

#: Fixed value: the white space of the tokenizers' patterns (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WIDE_SPACE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: White space and the run after it; a run of plain letters ends where other ASCII begins.
PART = re.compile(
    f"[{SPACE}]*[{LETTERS}]+(?=[\\t-\\r -@\\[-`{{-~]|\\Z)|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
)
PLAIN_WORD = re.compile(f" ?[{LETTERS}]+\\Z")
#: Where a blank may touch other white space, a cut before it is not always one of the tokenizer's.
RARE_BLANKS = ("\t", "\r", "\v", "\f")
TOUCHING = ("  ", " \n", "\n ", "\t", "\r", "\v", "\f")

#: What stands for a blank in the byte alphabet; ASCII letters stand for themselves.
BLANK = "\u0120"

_encoders: dict[tuple[str, bool], Encoder] = {}


def _printable_bytes() -> dict[int, int]:
    """The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, others for code points from 256 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = itertools.count(256)
    return {b: b if b in kept else next(others) for b in range(256)}


class _Memory(dict):
    """Computes what is asked for the first time; forgets all when it is full."""

    def __init__(self, compute: Callable[[str], bytes], limit: int):
        super().__init__()
        self.compute = compute
        self.limit = limit

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[key] = value = self.compute(key)
        return value


class Encoder:
    """Encodes texts; remembers the ids of up to ``memory`` words and as many parts of words.

    Ids are little-endian unsigned 32-bit. A special token's name inside a text
    gives its id, as by the library's default; with ``names_as_text`` it is
    ordinary text, so that no document can smuggle in an end of text.
    """

    def __init__(self, path: str, memory: int = 650_000, names_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = names_as_text
        added = {} if names_as_text else self.tokenizer.get_added_tokens_decoder()
        self.named = {t.content: array("I", [token]).tobytes() for token, t in added.items()}
        self.names = sorted(self.named, key=len, reverse=True)
        self.cut_names = re.compile(f"({'|'.join(map(re.escape, self.names))})")
        self.model = self.tokenizer.model
        self.largest_id = max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.bytes = _printable_bytes()
        # White space without an id of its own leads nowhere, and case is folded with it.
        self.folds = not self._whole("\n") and self._whole("A") == self._whole("a")
        self.parts = _Memory(self._part, memory)
        self.words = _Memory(lambda word: self._ids(f" {word}"), memory)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def _part(self, part: str) -> bytes:
        if not PLAIN_WORD.match(part):
            return self._whole(part)
        if self.folds:
            part = part.lstrip(" ").lower()
        if part.isascii():
            coded = part.replace(" ", BLANK)
        else:
            coded = part.encode().decode("latin-1").translate(self.bytes)
        return array("I", [t.id for t in self.model.tokenize(coded)]).tobytes()

    def _ids(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PART.findall(text)))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text; null is encoded like an empty text."""
        ids_of = self.words.__getitem__
        for text in texts:
            if not text:
                yield b""
            elif any(name in text for name in self.names):
                # the tokenizer cuts at names first; what lies between is a text of its own
                cut = enumerate(self.cut_names.split(text))
                yield b"".join(self.named[piece] if k % 2 else next(self.encode([piece])) for k, piece in cut)
            elif self.folds and not any(t in text for t in RARE_BLANKS) and (text.isascii() or WIDE_SPACE.search(text) is None):
                # all white space is alike, so words are remembered without what ends their line
                yield b"".join(map(ids_of, text.replace("\n", " ").split(" ")))
            elif any(t in text for t in TOUCHING) or not (text.isascii() or WIDE_SPACE.search(text) is None):
                yield self._ids(text)
            else:
                first, *rest = text.split(" ")
                yield self._ids(first) + b"".join(map(ids_of, rest))


def encoder(path: str, names_as_text: bool = False) -> Encoder:
    """The encoder of a file, one per worker process."""
    key = path, names_as_text
    if key not in _encoders:
        _encoders[key] = Encoder(path, names_as_text=names_as_text)
    return _encoders[key]


def vocabulary_path(name: str) -> str:
    """Where the public tokenizer files are installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
