"""Sharding, mixing, packing and records: laws, round trips and edge rows."""

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gleaner.llm import mixing, packing, records, sharding
from gleaner.llm.tokens import Encoder, vocabulary_path
from pyspark.sql import functions as F


def jump_one(key, shards):
    at, upto = -1, 0
    while upto < shards:
        at = upto
        key = (key * 2862933555777941757 + 1) % 2**64
        upto = int((at + 1) * (2**31 / ((key >> 33) + 1)))
    return at


def test_jump_is_the_published_function_and_moves_rows_only_to_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**64, 3000, dtype=np.uint64)
    for shards in (1, 2, 7, 40, 41, 1000):
        assert sharding.jump(keys, shards).tolist() == [jump_one(int(k), shards) for k in keys]
    old, new = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert set(new[old != new].tolist()) == {40}


def test_shards_of_edge_rows(edges, empty):
    rows = sharding.sharded(edges).collect()
    assert len(rows) == edges.count()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 40)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    null = next(r for r in rows if r.doc_id == 1)
    assert (null.size, null.text_crc32) == (16, 0)
    long = next(r for r in rows if r.doc_id == 7)
    assert (long.size, long.text_crc32) == (150_016, zlib.crc32(b"word " * 30_000))
    assert sharding.sharded(empty).collect() == []


def water(sizes, share=1.5, ceiling=2.0):
    """Targets by sharing the rest again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    rest, open_ = share * sum(sizes.values()), [s for s in names]
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        given = {s: rest * weight[s] / total for s in open_}
        rest = 0.0
        for s in open_:
            target[s] += given[s]
            if target[s] > ceiling * sizes[s]:
                rest += target[s] - ceiling * sizes[s]
                target[s] = ceiling * sizes[s]
        open_ = [s for s in open_ if target[s] < ceiling * sizes[s]]
    return target


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_mix_meets_its_targets(which, request):
    docs = request.getfixturevalue(which)
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == sum(c.to_word - c.from_word for c in r.cuts)
    expected = water(sizes)
    for source, target in targets.items():
        assert target == pytest.approx(expected[source])
        assert abs(taken[source] - target) <= 40
    again = {(r.doc_id, r.size, r.taken) for r in mixing.mixed(docs).collect()}
    assert again == {(r.doc_id, r.size, r.taken) for r in rows}


def test_shards_of_the_mix_have_one_size_and_laps_are_disjoint(documents):
    rows = mixing.mixed(documents, shards=4).collect()
    words, laps = Counter(), defaultdict(list)
    for r in rows:
        for c in r.cuts:
            words[c.shard] += c.to_word - c.from_word
            laps[r.doc_id, c.lap].append((c.from_word, c.to_word))
    assert max(words.values()) - min(words.values()) <= 8 * 41
    for cuts in laps.values():
        cuts.sort()
        assert all(a[1] <= b[0] for a, b in zip(cuts, cuts[1:], strict=False))


def test_mixed_documents_carry_the_taken_words(documents, edges, empty):
    plan = {r.doc_id: r for r in mixing.mixed(documents).collect()}
    counted = Counter()
    rows = mixing.mixed_documents(documents)
    assert rows.columns == documents.columns
    for r in rows.collect():
        counted[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert counted == Counter({d: r.taken for d, r in plan.items() if r.taken})
    assert mixing.mixed_documents(edges).columns == edges.columns
    assert mixing.mixed_documents(edges).count() > 0
    assert mixing.mixed_documents(empty).collect() == []


CHARS = " \n\t\r ab'sdLLéñİß1²!?<|endoftext|>\x1c\x85\xa0　́\U0001f642"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_tokenizer(name, documents):
    encoder = Encoder(vocabulary_path(name), memory=50)
    library = Tokenizer.from_file(vocabulary_path(name))

    def plain(text):
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(st.sampled_from(CHARS), max_size=30), max_size=4))
    def same(texts):
        assert list(encoder.encode(texts)) == [plain(t) for t in texts]

    same()
    texts = [r.text for r in documents.limit(60).collect()]
    assert list(encoder.encode(texts)) == [plain(t) for t in texts]
    assert list(encoder.encode([None, ""])) == [b"", b""]
    named = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|startoftext|>A", "<|EndOfText|> z"]
    assert list(encoder.encode(named)) == [plain(t) for t in named]
    library.encode_special_tokens = True
    assert list(Encoder(vocabulary_path(name), names_as_text=True).encode(named)) == [plain(t) for t in named]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_plan_holds_every_piece_once(lengths):
    plan = packing.best_two_fit(Counter(lengths), 64)
    dealt = Counter()
    for n, pattern in plan:
        assert sum(pattern) <= 64
        for length in pattern:
            dealt[length] += n
    assert dealt == Counter(lengths)


def test_two_tighter_documents_replace_the_smallest():
    # Greedy gives 60 + 25, gap 15; the 25 makes room for 21 + 19, which fit its 40 exactly.
    assert packing.best_two_fit(Counter([60, 25, 21, 19]), 100)[0] == (1, (60, 21, 19))


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_packed_sequences_are_whole(which, request):
    docs = request.getfixturevalue(which)
    packed = packing.pack_documents(docs, keep_ids=True)
    rows = packed.collect()
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"))
    expected = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = next(encoder.encode([r.text])) + struct.pack("<I", 2)
        cuts = list(range(len(ids) // 4, 0, -1024))[::-1]
        for piece, (low, high) in enumerate(zip([0, *cuts[:-1]], cuts, strict=True)):
            expected[r.doc_id, piece, low, ids[4 * low : 4 * high]] += 1
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        ends = [0]
        for offset, length in spans:
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 1024
    assert len(places) <= 1.01 * -(-sum(r.length for r in rows) // 1024) + 1
    joined = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    assert sum(map(len, joined.values())) == 4 * sum(r.length for r in rows)


def test_no_documents_give_no_sequences(empty):
    assert packing.pack_documents(empty).collect() == []


def test_checksums_are_crc32c():
    assert records.crc32c([b"123456789", bytes(32), bytes([255] * 32)]).tolist() == [0xE3069283, 0x8A9136AA, 0x62A8AB43]
    assert records.crc32c([b"", b"a", b"123456789"]).tolist() == [0, 0xC1D04330, 0xE3069283]
    rng = np.random.default_rng(0)
    payloads = [rng.bytes(n) for n in (4, 8, 511, 512, 513, 5000)]
    data = list(records.frames(payloads))
    offsets = np.cumsum([0, *map(len, data)])[:-1]
    sizes = np.array([len(p) for p in payloads])
    assert records.unframed(b"".join(data), offsets, sizes) == payloads
    broken = bytearray(b"".join(data))
    broken[-9] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        records.unframed(bytes(broken), offsets, sizes)


@pytest.mark.parametrize("which", ["documents", "edges", "empty"])
def test_records_come_back_in_order(which, request, spark):
    docs = request.getfixturevalue(which)
    encoder = Encoder(vocabulary_path("word_bpe_49k.json"))
    rows = [(r.doc_id, next(encoder.encode([r.text])) + struct.pack("<I", 2)) for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    expected, start = [], 0
    for doc, ids in rows:
        expected.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    found = records.token_table(spark, docs).orderBy("start").collect()
    assert [tuple(r) for r in found] == expected


def test_shuffled_reads_give_every_record_once(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 20_000)
    records.write_records(documents, str(tmp_path / "data")).write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    assert files.count() > 4
    whole = {(r.part, r.file_no, r.position): (r.doc_id, bytes(r.ids)) for r in records.read_records(files).collect()}
    orders = []
    for seed, parts in ((1, 3), (1, 5), (2, 3)):
        rows = records.shuffled_records(files, seed, parts).collect()
        assert {(r.part, r.file_no, r.position): (r.doc_id, bytes(r.ids)) for r in rows} == whole and len(rows) == len(whole)
        orders.append([r.doc_id for r in sorted(rows, key=lambda r: (r.turn, r.part, r.file_no, r.position))])
    assert orders[0] == orders[1] != orders[2] and orders[0] != sorted(orders[0])
    wanted = list(whole)[::7]
    some = records.chosen_records(files, spark.createDataFrame(wanted, "part int, file_no int, position long")).collect()
    assert {(r.part, r.file_no, r.position): (r.doc_id, bytes(r.ids)) for r in some} == {p: whole[p] for p in wanted}
    assert records.shuffled_records(files.where("false")).collect() == []
