"""The registered queries, and SQL where there is some."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import STAGES, keep_languages, keep_one_of_copies, keep_quality, mix_sources, pack, run
from gleaner.llm import mixing, quality
from gleaner.llm.queries import ORACLES, QUERIES
from gleaner.llm.tokens import Encoder, vocabulary_path
from tests.compare import connect, difference
from tests.llm.test_copies import plain_print, roots

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


def test_pipeline_stages_return_documents(spark, documents, edges):
    for docs in (documents, edges):
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        for _, stage in STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert "_row" not in docs.columns or {r._row for r in out.select("_row").collect()} <= {"clash"}
            assert {r.doc_id for r in out.select("doc_id").collect()} <= ids


def test_pipeline_against_plain_stages(spark, documents):
    """Each stage's rows against a plain version over what its predecessor kept."""
    by_id = {r.doc_id: r.text for r in documents.collect()}
    told = keep_languages(spark, documents, SF)
    assert {r.doc_id for r in told.collect()} == {d for d, t in by_id.items() if t and re.search(r"[^\W\d_]", t)}
    good = keep_quality(spark, told, SF)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.judged(told).where("kept").collect()}
    kept = keep_one_of_copies(spark, good, SF)
    prints = {r.doc_id: plain_print(r.text) for r in good.collect()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    assert {r.doc_id for r in kept.collect()} == set(roots(prints, pairs).values())
    mixed = mix_sources(spark, kept, SF)
    taken = {r.doc_id: r.taken for r in mixing.mixed(kept).collect() if r.taken}
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == taken
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"))
    total = Counter()
    for r in mixed.collect():
        total[r.doc_id] += len(next(encoder.encode([r.text]))) // 4 + 1
    packed = Counter()
    for r in pack(spark, mixed, SF).collect():
        packed[r.doc_id] += r.length
        assert r.offset + r.length <= 1024
    assert packed == total


def test_pipeline_stages_of_no_rows_and_of_no_labels(spark, edges, empty):
    docs = empty
    for _, stage in STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []
    unlabelled = edges.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id or 0 for r in keep_languages(spark, unlabelled, SF).collect()) == [-9, 0, 4, 4, 5, 7, 8]


def test_pipeline_packs_what_the_stages_keep(spark):
    rows = run(spark, SF).collect()
    assert rows and max(r.offset + r.length for r in rows) <= 1024
