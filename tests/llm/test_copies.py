"""Near copies of texts and vectors, and components, against brute force."""

import math
import re

import numpy as np
import pytest
import xxhash

from corpus_pipeline import keep_one_of_copies
from gleaner.llm import components, simhash, vectors


def plain_print(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not found:
        return 0
    shingles = [" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(ids, pairs):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def test_fingerprints():
    for text in (None, "", "A", "a B", "Ä b C d É e", "x " * 9000, "one two\x0bthree four\x85 five"):
        assert simhash.fingerprint(text) == plain_print(text)


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
def test_close_pairs_are_all_pairs(bits):
    rng = np.random.default_rng(bits)
    for n in (1, 2, 17, 700):
        base = rng.integers(0, 2**63, max(1, n // 20), dtype=np.uint64)
        codes = base[rng.integers(0, len(base), n)]
        for _ in range(4):
            codes = codes ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64))
        codes = np.unique(codes)
        codes = codes[np.argsort(simhash.gray_rank(codes))]
        i, j = simhash.close_pairs(codes, bits)
        near = np.triu(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= bits, 1)
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == list(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_divided_nodes_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**62))
    codes = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (150, 2))} | {int(x) for x in rng.integers(0, 2**63, 100)}
    codes = sorted(codes)
    rows = [(c - 2**64 if c >> 63 else c, k) for k, c in enumerate(codes)]
    frame = spark.createDataFrame(rows, "fp long, doc_id long")
    expected = roots(range(len(codes)), [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 2])
    for limit in (5, 2048):
        found = {r.fp: r.component_id for r in simhash.fingerprint_groups(frame, 2, limit).collect()}
        assert found == {fp: expected[k] for fp, k in rows}


@pytest.mark.parametrize("which", ["documents", "edges", "empty"])
def test_near_copies(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, plain_print(r.text)) for r in docs.select("doc_id", "text").collect()]
    prints = sorted({fp for _, fp in rows})
    classes = roots(prints, [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2])
    smallest = {}
    for doc, fp in rows:
        if doc is not None:
            smallest[classes[fp]] = min(doc, smallest.get(classes[fp], doc))
    found = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_copies(docs).collect()), key=str)
    assert found == sorted(((doc, fp, smallest.get(classes[fp])) for doc, fp in rows), key=str)


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(k, k + 1) for k in range(60)]
    star = [(1000, 1000 + k) for k in range(1, 200)] + [(7000, 7000)]
    found = {r.id: r.root for r in components.components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 1000 for k in range(1, 200)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_vector_links(spark):
    rng = np.random.default_rng(5)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(260, 8)))]
    rows += [(1000 + k, (np.array(rows[k][1]) * 3 + rng.normal(size=8) * 0.2).tolist()) for k in range(120)]
    rows += [(2000 + k, rows[0][1]) for k in range(40)] + [(5, rows[5][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 8), (3003, [math.nan] * 8), (3004, [1.0, None] * 4), (3005, [math.inf] * 8)]
    rows += [(3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e-200] * 8), (3009, [1e200] * 8), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(map(abs, v))
        v = np.array(v) / top
        return v / np.sqrt(v @ v)

    units = [unit(v) for _, v in rows]
    n = len(rows)
    linked = [
        (a, b) for a in range(n) for b in range(a)
        if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9
    ]
    classes, degree = roots(range(n), linked), [0] * n
    for a, b in linked:
        degree[a] += 1
        degree[b] += 1
    smallest = {}
    for k, (vec, _) in enumerate(rows):
        if vec is not None:
            smallest[classes[k]] = min(vec, smallest.get(classes[k], vec))
    expected = sorted(((vec, degree[k], smallest.get(classes[k])) for k, (vec, _) in enumerate(rows)), key=str)
    for interval in (32, 4096):
        found = vectors.vector_links(frame, interval=interval).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == expected
    assert vectors.vector_links(frame.where("false")).collect() == []


def texts_with_copies():
    """Texts of 6 to 3,000 words, exact copies, copies with words changed, and blanks."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 3000, n)) for n in rng.integers(6, 3000, 40)]
    for base in texts[:40]:
        for changes in (0, 1, 3, 9):
            words = base.split()
            for at in rng.integers(0, len(words), changes):
                words[at] = f"new{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    return [*texts, None, "", " ", "One two", "one TWO", "one two three"]


def test_the_stage_keeps_one_text_of_each_group(spark):
    texts = texts_with_copies()
    prints = [plain_print(t) for t in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    expected = sorted(set(roots(range(len(texts)), pairs).values()))
    assert 40 <= len(expected) < len(texts) - 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in keep_one_of_copies(spark, docs, "").collect()) == expected


def test_the_stage_keeps_all_columns_of_edge_rows(spark, edges, empty):
    kept = keep_one_of_copies(spark, edges, "")
    assert kept.columns == edges.columns
    assert {r._row for r in kept.collect()} == {"clash"}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-9, 1, 4, 6, 7, 8]
    assert keep_one_of_copies(spark, empty, "").collect() == []
