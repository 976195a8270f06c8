"""The pipeline against brute force, stage by stage and as a whole; the queries' contracts on the small tables."""

import collections
import zlib

import numpy as np
import pytest

import corpus_pipeline
from eventide.llm import icws, mixing, queries, secrets, stages, toxicity
from eventide.llm import tokens as T
from eventide.llm.common import table

from .test_mixing_and_chat import draw
from .test_near_duplicates import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def by_stage(spark):
    """Each stage's rows, run as the pipeline runs them."""
    docs, out = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        from eventide.llm.common import write_work
        docs, _ = write_work(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_the_five_in_order():
    assert [f for _, f in corpus_pipeline.STAGES] == [stages.toxicity, stages.near_dedup, stages.secrets,
                                                      stages.mixing, stages.packing]


def test_toxicity_stage(spark, by_stage):
    docs = table(spark, SF, "documents")
    assert by_stage["toxicity"].columns == COLUMNS
    net = toxicity.fit(docs, table(spark, SF, "labels"))
    want = {r.doc_id for r in toxicity.score(docs, net).collect() if r.predicted == 0}
    assert set(texts(by_stage["toxicity"])) == want


def test_near_dedup_stage(by_stage):
    rows = sorted(texts(by_stage["toxicity"]).items())
    links = brute([t for _, t in rows])
    keep, seen = [], set()
    for i in range(len(rows)):
        if i not in seen:
            keep.append(rows[i][0])
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen.add(k)
                    todo += links[k]
    assert sorted(texts(by_stage["near_dedup"])) == keep
    assert by_stage["near_dedup"].columns == COLUMNS


def test_secrets_stage(by_stage):
    before, after = texts(by_stage["near_dedup"]), by_stage["secrets"].collect()
    assert {r.doc_id: r.text for r in after} == {i: secrets.redacted(t) for i, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in after)


def test_mixing_stage(by_stage):
    rows = by_stage["secrets"].collect()
    n = collections.Counter(r.source for r in rows)
    want = collections.Counter()
    for r in rows:
        want[r.doc_id] += draw(r.doc_id, 1.0 / len(n) * len(rows) / n[r.source])
    got = by_stage["mixing"]
    assert got.columns == COLUMNS
    assert collections.Counter(r.doc_id for r in got.collect()) == +want


def test_packing_stage_and_whole_run(spark, by_stage):
    tok = T.load(T.default_tokenizer())
    docs = by_stage["mixing"].collect()
    ids = {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [1] for r in docs}
    copies = collections.Counter(r.doc_id for r in docs)
    total = sum(len(ids[i]) * n for i, n in copies.items())
    for pieces in (by_stage["packing"].collect(), corpus_pipeline.run(spark, SF).collect()):
        assert sum(p.length for p in pieces) == total
        covered = collections.Counter()
        for p in pieces:
            assert p.doc_tokens == len(ids[p.doc_id])
            part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            covered[p.doc_id] += p.length
        assert covered == collections.Counter({i: len(ids[i]) * n for i, n in copies.items()})
        assert {p.sequence_id for p in pieces} == set(range(-(-total // 2048)))


FIRST_COLUMNS = {
    "op1_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_pack": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op5_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op6_near_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op7_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op9_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
}


def test_queries_have_the_columns_asked_for(spark):
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))
    for name, columns in FIRST_COLUMNS.items():
        assert queries.QUERIES[name](spark, SF).columns[:len(columns)] == columns, name


def test_no_documents(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SF).count() == 0


def test_icws_and_mixing_keep_clashing_columns(odd_docs):
    assert icws.deduplicated(odd_docs).columns == odd_docs.columns
    assert mixing.replicate(odd_docs).columns[:len(odd_docs.columns)] == odd_docs.columns
