"""Conversation trie, whitening and byte-pair encoding against brute force, the library and edge rows."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import bpe, trie, whitening
from gleaner.llm.tokens import vocabulary_path

# --- trie --------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def plain_nodes(convs):
    """Rows of the trie of {conv_id: list of (role, text)}, node by node."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(convs):
        turns = tuple(convs[conv])
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
        ends[turns].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, convs_in in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += node not in children
            saved[node[:depth]] += (len(convs_in) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0, role or "", text or ""), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def found_nodes(frame):
    return sorted(tuple(r) for r in frame.select([c.split()[0] for c in trie.NODE.split(", ")]).collect())


def some_turns(n, seed, most=7):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in rng.permutation(n).tolist():
        size = int(rng.integers(0, most))
        for turn in range(size):
            rows.append((conv, turn, "user" if turn % 2 else "bot", f"text {int(rng.integers(0, 3))}" * (turn + 1)))
    return rows


EDGE_TURNS = [
    (1, 0, None, "a"), (1, 0, "", "a"), (1, None, "x", None), (1, None, None, ""), (1, 2, "user", "long " * 40_000),
    (2, 5, "user", "é\U0001f642"), (2, 5, "user", "é\U0001f642"), (2, 4, "", "a"), (None, 0, "user", "nobody"), (None, None, None, None),
    (-3, 0, "user", "a"), (-5, 0, "user", "b"), (-5, 1, "user", "c"), (7, 0, "a:", "b"), (8, 0, "a", ":b"), (40, 1, "user", "z"),
]


@pytest.mark.parametrize("which", ["random", "edges", "driver"])
def test_trie_is_that_of_brute_force(spark, which):
    if which == "driver":
        frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    else:
        rows = EDGE_TURNS if which == "edges" else some_turns(400, 1)
        frame = spark.createDataFrame(rows, TURNS)
        for name in ("key", "sizes", "n", "low", "ends", "seq", "part", "node", "t", "base", "digests"):
            frame = frame.withColumn(name, F.lit("clash"))
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert found_nodes(trie.prefix_trie(frame)) == plain_nodes(plain_rebuilt(rows))


def test_runs_and_levels_are_merged(spark, monkeypatch):
    rows = some_turns(500, 2) + [(c, t, "user", f"hot {t}") for c in range(1000, 1400) for t in range(4)]
    frame = spark.createDataFrame(rows, TURNS)
    expected = plain_nodes(plain_rebuilt(rows))
    monkeypatch.setattr(trie, "CHUNK", 7)
    for run, fan in ((16_384, 2), (5, 2), (9, 64)):
        monkeypatch.setattr(trie, "RUN", run)
        monkeypatch.setattr(trie, "FAN", fan)
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        try:
            assert found_nodes(trie.prefix_trie(frame)) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


@settings(max_examples=150, deadline=None)
@given(st.sets(st.lists(st.sampled_from("abc"), max_size=5).map(tuple), min_size=1, max_size=25), st.integers(1, 9))
def test_contracted_runs_fold_like_one(words, size):
    words = sorted(words)

    def paths():
        out = []
        for k, w in enumerate(words):
            key = b"".join(c.encode() * trie.WIDTH for c in w)
            out.append(trie.Path(key, [ord(c) for c in w], [trie.Node(k + 1, k, ends=str(k) if at == len(w) else None) for at in range(len(w) + 1)]))
        return out

    def plain(rows, names):
        return sorted(tuple((r["parent_conv_id"] if r.get("parent_node") is None else names[r["parent_node"]]) if c == "parent_conv_id" else r.get(c)
                            for c in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
                      for r in rows)

    one, left = trie.fold(paths(), whole=True, named=True)
    for r in one:
        r.setdefault("parent_conv_id", None)
    assert not left
    rows, opened = [], []
    every = paths()
    for at in range(0, len(every), size):
        closed, own = trie.fold(every[at : at + size], named=True)
        rows += closed
        opened += own
    closed, left = trie.fold(opened, whole=True, named=True)
    rows += closed
    for r in rows:
        r.setdefault("parent_conv_id", None)
    names = {r["node"]: r["conv_id"] for r in rows}
    assert len(names) == len(rows) and not left

    def text(x):
        return [tuple(-1 if v is None else v for v in row) for row in x]

    assert sorted(text(plain(rows, names))) == sorted(text(plain(one, {})))


def test_an_empty_table_has_no_node(spark):
    assert trie.prefix_trie(spark.createDataFrame([], TURNS)).collect() == []


# --- whitening ---------------------------------------------------------------


def check_whitening(rows, found, components=32):
    """Compares with a dense eigendecomposition; eigenspaces that are close are compared by their projections."""
    clean = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(v) for _, v in clean)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in clean], object)
    n, sums = len(x), x.sum(axis=0)
    off = (n * x - sums).astype(float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = min(components, int((values > 1e-10 * values[0]).sum()))
    deviation = sorted(sum(int(v) ** 2 for v in row) for row in n * x - sums)
    assert len(found) == n * width
    assert sorted(r.deviation for r in found if r.component == 1) == deviation
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error <= 1e-8
    white = defaultdict(dict)
    for r in found:
        white[r.vec_id][r.component] = r.whitened
        assert abs(r.explained - values[r.component - 1] / values.sum()) <= 1e-9 * r.explained
    own = np.array([[white[i][c] for c in range(1, width + 1)] for i, _ in clean])
    plain = off @ vectors[:, :width] / np.sqrt(values[:width])
    for c in range(width):
        gap = min(abs(values[c] - values[k]) for k in range(len(values)) if k != c) if len(values) > 1 else values[0]
        if gap > 1e-6 * values[0]:
            assert min(np.abs(own[:, c] - plain[:, c]).max(), np.abs(own[:, c] + plain[:, c]).max()) < 1e-6


def test_whitening_of_a_wide_spectrum(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(900, 70)) @ np.diag(np.linspace(3, 0.3, 70))
    data[:, :4] += rng.normal(size=(900, 1)) * 20
    rows = [(k, v.tolist()) for k, v in enumerate(data)]
    rows += [(5000, None), (5001, [math.nan] * 70), (5002, [1.0] * 69 + [None]), (5003, [math.inf] * 70), (5004, [-math.inf] * 70)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash")).withColumn("x", F.lit(1))
    check_whitening(rows, whitening.whitened(frame.repartition(5)).collect())


def test_whitening_of_the_driver_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    check_whitening(rows, whitening.whitened(frame).collect())


def test_whitening_of_edge_tables(spark):
    schema = "vec_id long, embedding array<float>"
    few = [(1, [1.0, 2.0, 0.5]), (2, [0.0, 1.0]), (3, []), (4, [2.0, -1.0, 0.5])]
    check_whitening(few, whitening.whitened(spark.createDataFrame(few, schema)).collect())
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).collect() == []
    ties = [(1, [1.0, 0.0]), (1, [-1.0, 0.0]), (None, [0.0, 1.0]), (2, [0.0, -1.0])]
    found = whitening.whitened(spark.createDataFrame(ties, schema)).collect()
    assert len(found) == 8 and found[0].identity_error < 1e-8
    assert all(abs(r.explained - 0.5) < 1e-12 for r in found)


def test_the_filter_finds_what_a_narrow_gap_hides():
    rng = np.random.default_rng(9)
    basis, _ = np.linalg.qr(rng.normal(size=(120, 120)))
    values = np.concatenate([np.linspace(1.07, 1.0, 34), np.linspace(0.999, 0.93, 86)])
    matrix = basis @ np.diag(values) @ basis.T
    found = whitening.leading_pairs(lambda q: matrix @ q, 120, float(values.sum()), 32)
    assert np.abs(found.values - values[:32]).max() < 1e-12
    assert np.abs(np.abs((basis[:, :32] * found.vectors).sum(axis=0)) - 1).max() < 1e-9
    assert found.passes < 150
    low, high = whitening.lanczos_bounds(lambda q: matrix @ q, 120)
    assert low <= 0.93 + 1e-9 and high >= 1.07 - 1e-9


# --- byte-pair encoding ------------------------------------------------------

PIECES = [
    " ", "  ", "\n", "\t", "a", "the", "'s", "'ll", "'LL", "é", "ß", "１", "²", "中", "\U0001f642", "\x1c", "\x85", "᠎", "​", "\xa0",
    "<|endoftext|>", "<|endof", "՘", "꟎", "ก", "ا", "́", "12", "!!", "aaaaaaa", "ing", "er", "zz", "\x00", "﻿",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Bpe(vocabulary_path("byte_bpe_50k.json"))


@settings(max_examples=1500, deadline=None)
@given(text=st.one_of(st.lists(st.sampled_from(PIECES), max_size=16).map("".join), st.text(max_size=30)))
def test_ids_and_texts_are_the_librarys(vocabulary, text):
    ids = vocabulary.library.encode(text, add_special_tokens=False).ids
    own = vocabulary.encode(text)
    assert np.frombuffer(own, "<u4").tolist() == ids
    assert vocabulary.decoded_text(own) == vocabulary.library.decode(ids, skip_special_tokens=False)


@settings(max_examples=800, deadline=None)
@given(word=st.text(st.sampled_from("abcdeilnorstuzéx"), max_size=60))
def test_backtracking_gives_the_merges(vocabulary, word):
    assert vocabulary.merge(word.encode()) == vocabulary.library.encode(word, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ids=st.lists(st.integers(0, 50_256), max_size=12))
def test_any_ids_decode_like_the_library(vocabulary, ids):
    own = np.array(ids, "<u4").tobytes()
    assert vocabulary.decoded_text(own) == vocabulary.library.decode(ids, skip_special_tokens=False)
    assert bpe._sha_of(own_piece for one in ids for own_piece in vocabulary.decode(np.array([one], "<u4").tobytes())) == (
        hashlib.sha256(vocabulary.decoded_text(own).encode()).hexdigest()
    )


def test_a_long_word_and_a_full_memory(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "IDS", 1000)
    word = "abracadabra" * 30_000
    ids = vocabulary.library.encode(word, add_special_tokens=False).ids
    assert np.frombuffer(vocabulary.encode(word), "<u4").tolist() == ids
    assert b"".join(vocabulary.decode(np.array(ids, "<u4").tobytes())) == word.encode()
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    text = "many different words of one text and the same words of one text"
    assert np.frombuffer(vocabulary.encode(text), "<u4").tolist() == vocabulary.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["documents", "edges", "empty"])
def test_token_digests(which, request, vocabulary):
    docs = request.getfixturevalue(which)
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = vocabulary.library.encode(r.text or "", add_special_tokens=False).ids
        text = vocabulary.library.decode(ids, skip_special_tokens=False)
        expected[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.token_digests(docs).collect()) == expected
    back = Counter((r.doc_id, r.text) for r in bpe.decoded(bpe.encoded(docs)).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
