"""Language identification by cross-parsing entropy.

For every language a suffix automaton of labelled text is built. A text is parsed
against it from left to right into the longest phrases that occur in the labelled
text; a text in the same language needs fewer phrases. The language with the
fewest phrases wins, normalised by the length of the text and by the size of the
labelled text, as a phrase of a larger text says less: phrases * log2(size) / length.

The automaton of a language is turned into one table: from a state and a symbol to
the next state, with a flag where the longest match ends and a new phrase begins.
Texts are cut into strips of ``STRIP`` symbols whose phrase counts are added, so
that a task walks thousands of strips of many texts side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bound of the labelled sample: characters of each language that its automaton holds.
SAMPLE_CHARS = 24_000
#: Bound of what one labelled text may give, so that no text or group of copies is most of a sample.
TEXT_CHARS = 400
#: Symbols of the common alphabet; all other letters are one symbol that no sample holds.
SYMBOLS = 64
STRIP = 256
UNKNOWN = "und"


@dataclass
class Models:
    """Languages with the step tables of their automata over one alphabet."""

    languages: list[str]
    alphabet: dict[str, int]
    steps: list[np.ndarray]
    #: Bits that one phrase takes: log2 of the symbols in the sample.
    bits: list[float]

    def codes(self) -> np.ndarray:
        """Symbol of every code point: 0 for what is no letter, 1 for letters that no sample has."""
        table = _folded_letters()
        known = np.ones(0x110000, np.uint8)
        for char, symbol in self.alphabet.items():
            known[ord(char)] = symbol
        return np.where(table > 0, known[table], 0).astype(np.uint8)


def _folded_letters() -> np.ndarray:
    """The lower-case form of every letter, 0 for every other code point."""
    table = np.zeros(0x110000, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def symbols_of(text: str, codes: np.ndarray) -> np.ndarray:
    """Symbols of a text, with each run of other characters folded into one 0."""
    found = codes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    return found[(found > 0) | np.append(True, found[:-1] > 0)] if len(found) else found


def suffix_automaton(symbols: np.ndarray) -> tuple[list[dict[int, int]], list[int]]:
    """(edges, suffix links) of the smallest automaton of all substrings; state 0 is the empty one."""
    edges: list[dict[int, int]] = [{}]
    links, longest, last = [-1], [0], 0
    for symbol in symbols.tolist():
        new = len(edges)
        edges.append({})
        longest.append(longest[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = new
            at = links[at]
        if at >= 0:
            target = edges[at][symbol]
            if longest[at] + 1 == longest[target]:
                links[new] = target
            else:
                twin = len(edges)
                edges.append(dict(edges[target]))
                longest.append(longest[at] + 1)
                links.append(links[target])
                while at >= 0 and edges[at].get(symbol) == target:
                    edges[at][symbol] = twin
                    at = links[at]
                links[target] = links[new] = twin
        last = new
    return edges, links


def step_table(symbols: np.ndarray, width: int = SYMBOLS) -> np.ndarray:
    """next[state * width + symbol] = 2 * (next state * width) + (1 where a new phrase begins).

    Where a state has no edge for the symbol, the phrase ends and the next one
    begins with that symbol, from the empty state. A symbol that occurs nowhere is a phrase of its own.
    """
    edges, _ = suffix_automaton(symbols)
    first = np.zeros(width, np.int64)
    for symbol, target in edges[0].items():
        first[symbol] = target
    table = np.tile(2 * width * first + 1, (len(edges), 1))
    rows = np.fromiter((s for s, e in enumerate(edges) for _ in e), np.int64)
    columns = np.fromiter((c for e in edges for c in e), np.int64)
    targets = np.fromiter((t for e in edges for t in e.values()), np.int64)
    table[rows, columns] = 2 * width * targets
    # The first symbol of a strip begins a phrase although the empty state has an edge for it.
    table[0] |= 1
    return table.ravel().astype(np.int32)


def phrase_counts(texts: list[str | None], codes: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases by text and language, symbols by text) of whole texts."""
    phrases = np.zeros((len(texts), len(steps)), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    strips, owners, held = [], [], 0

    def walk() -> None:
        flat = np.concatenate(strips)
        # Strips stand in rows; short last ones are filled with a symbol that is not counted.
        lengths = np.array([len(s) for s in strips])
        pieces = -(-lengths // STRIP)
        padded = np.full(int(pieces.sum()) * STRIP, 255, np.uint8)
        starts = np.repeat(np.append(0, np.cumsum(pieces)[:-1]) * STRIP - np.append(0, np.cumsum(lengths)[:-1]), lengths)
        padded[np.arange(len(flat)) + starts] = flat
        grid = np.ascontiguousarray(padded.reshape(-1, STRIP).T)
        owner = np.repeat(np.array(owners), pieces)
        fill = np.minimum(np.repeat(lengths, pieces) - STRIP * (np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(pieces)[:-1]), pieces)), STRIP)
        order = np.argsort(-fill, kind="stable")
        grid, owner, fill = grid[:, order].astype(np.int32), owner[order], fill[order]
        for language, table in enumerate(steps):
            state = np.zeros(len(owner), np.int32)
            count = np.zeros(len(owner), np.int32)
            for k in range(STRIP):
                open_ = int(np.searchsorted(-fill, -k))
                if not open_:
                    break
                step = table[state[:open_] + grid[k, :open_]]
                count[:open_] += step & 1
                state[:open_] = step >> 1
            np.add.at(phrases[:, language], owner, count)

    for row, text in enumerate(texts):
        found = symbols_of(text, codes) if text else codes[:0]
        sizes[row] = len(found)
        if len(found):
            strips.append(found)
            owners.append(row)
            held += len(found)
        if held > 1 << 21:
            walk()
            strips, owners, held = [], [], 0
    if strips:
        walk()
    return phrases, sizes


def labelled_sample(rows: DataFrame, sample_chars: int = SAMPLE_CHARS, text_chars: int = TEXT_CHARS) -> dict[str, list[str]]:
    """Up to ``sample_chars`` characters of distinct labelled texts (text, lang) of each language, at most ``text_chars`` of each.

    Which texts are taken depends on hashes of the texts alone, and equal texts
    count once. The share of a text is a window around its middle. The result
    has a proven bound: languages times ``sample_chars``.
    """
    wanted = max(1, sample_chars // text_chars)
    labelled = rows.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - text_chars) / 2).cast("int") + 1)
    windows = labelled.select("lang", F.substring("text", middle, F.lit(text_chars)).alias("window"), F.xxhash64("text").alias("code"))
    distinct = windows.groupBy("lang", "code").agg(F.min("window").alias("window"))
    ranked = distinct.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("code")))
    found: dict[str, list[str]] = {}
    for row in ranked.where(F.col("turn") <= wanted).orderBy("lang", "turn").collect():
        found.setdefault(row["lang"], []).append(row["window"])
    return found


def train(samples: dict[str, list[str]], symbols: int = SYMBOLS) -> Models:
    """Automata of the samples. The alphabet is the most frequent letters of all languages together, each weighing the same."""
    folded = _folded_letters()
    weight: dict[str, float] = {}
    for windows in samples.values():
        letters = [chr(c) for w in windows for c in folded[np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4")].tolist() if c]
        for char in letters:
            weight[char] = weight.get(char, 0.0) + 1 / len(letters)
    kept = sorted(weight, key=lambda c: (-weight[c], c))[: symbols - 2]
    models = Models(sorted(samples), {c: k + 2 for k, c in enumerate(sorted(kept))}, [], [])
    codes = models.codes()
    for language in models.languages:
        # Windows are joined by a blank, as words are.
        sample = symbols_of(" ".join(samples[language]), codes)
        models.steps.append(step_table(sample, symbols))
        models.bits.append(float(np.log2(len(sample) + 2)))
    return models


def language_of(text: Column, models: Models) -> Column:
    """struct(lang_pred, score) of whole texts.

    ``lang_pred`` is the language with the fewest phrases, the first by name of
    equals; ``und`` for null, for a text without a letter, and where nothing was
    learned. ``score`` is the share of bits that the winner saves against the
    runner-up, 0 for ``und``; with one language it is the share saved against one phrase per symbol.
    """
    spark_context = _context()
    shared = spark_context.broadcast(models)
    cached: dict[str, np.ndarray] = {}

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        if "codes" not in cached:
            cached["codes"] = own.codes()
        for texts in batches:
            yield predict(texts.tolist(), own, cached["codes"])

    spoken = F.when(text.rlike(r"\p{L}"), text)
    return predicted(spoken)


def predict(texts: list[str | None], models: Models, codes: np.ndarray) -> pd.DataFrame:
    phrases, sizes = phrase_counts(texts, codes, models.steps)
    if not models.languages:
        return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
    cost = phrases * np.array(models.bits)
    best = cost.argmin(axis=1)
    lowest = cost[np.arange(len(texts)), best]
    others = np.partition(cost, 1, axis=1)[:, 1] if len(models.languages) > 1 else sizes * models.bits[0]
    spoken = np.array([bool(t) for t in texts], bool) & (sizes > 0)
    score = np.where(spoken & (others > 0), 1 - lowest / np.maximum(others, 1e-9), 0.0)
    names = np.array(models.languages, object)[best]
    return pd.DataFrame({"lang_pred": np.where(spoken, names, UNKNOWN), "score": np.clip(score, 0.0, 1.0)})


def _context():
    from pyspark import SparkContext

    return SparkContext._active_spark_context


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of doc_id as text, modulo 4, is 2. A null doc_id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def learned(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, text_chars: int = TEXT_CHARS) -> Models:
    """Models of the labelled rows of ``docs`` (doc_id, text, lang) that are not held out."""
    return train(labelled_sample(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"), sample_chars, text_chars))


def languages(docs: DataFrame, models: Models | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score. Predictions read the text alone."""
    models = models or learned(docs)
    found = docs.select("doc_id", language_of(F.col("text"), models).alias("_found"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "_found.lang_pred", "_found.score")
