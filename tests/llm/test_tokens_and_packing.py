import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import common as C
from eventide.llm import packing as P
from eventide.llm import tokenbin as B
from eventide.llm import tokens as T


def plain(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(T.default_tokenizer())
    return [tok.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é'\n\t  .,1日\x1c", max_size=40), max_size=6))
def test_word_cache_gives_the_library_ids(texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in T.Encoder(T.default_tokenizer()).encode(texts)]
    assert got == plain(texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aTéßÿɏ×ж \n.,'s\"<|>²\u0345", max_size=40), max_size=6))
def test_plain_pieces_get_the_library_ids(texts):
    assert ids_of(T.Encoder(T.default_tokenizer()), texts) == plain(texts)


def ids_of(enc, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in enc.encode(texts)]


def test_special_strings_get_the_library_ids():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|><|endoftext|>  z", " <|endoftext|>\n <|endof"]
    enc = T.Encoder(T.default_tokenizer())
    assert ids_of(enc, texts) == plain(texts)
    assert ids_of(enc, [" ".join(texts)]) == plain([" ".join(texts)])


def test_long_texts_go_through_windows(words, monkeypatch):
    monkeypatch.setattr(T.Encoder, "WINDOW", 100)
    texts = ["x" * 3000, "  ".join(words), " ".join(words) + " \n " + "y z" * 200, "\n ".join(words), " " * 500]
    assert ids_of(T.Encoder(T.default_tokenizer()), texts) == plain(texts)


def test_small_cache_gives_the_same_ids(words):
    enc = T.Encoder(T.default_tokenizer(), max_bytes=20_000)
    texts = [" ".join(words[i:i + 30]) for i in range(0, 390, 10)]
    assert [np.frombuffer(enc.encode([t])[0], "<u4").tolist() for t in texts] == plain(texts)


def test_words_of_a_call_are_looked_up_once(monkeypatch):
    enc, seen = T.Encoder(T.default_tokenizer()), []
    look_up = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda words: seen.extend(words) or look_up(words))
    texts = ["it's a word, a word it's <|endoftext|>\n" * 50, "", " a word\u0378"]
    assert ids_of(enc, texts) == plain(texts)
    assert len(seen) == len(set(seen)) < 20


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32), st.integers(0, 300), st.integers(1, 64))
def test_segments_round_trip_and_give_ranges(bits, n, block):
    ids = np.random.default_rng(bits * 1000 + n).integers(0, 1 << bits, n).astype(np.uint32)
    buf = B.encode_segment(ids, bits, block)
    assert (B.decode_range(buf) == ids).all()
    for lo, hi in ((0, 1), (n // 3, 2 * n // 3), (n - 1, n + 5)):
        assert (B.decode_range(buf, max(0, lo), hi) == ids[max(0, lo):hi]).all()


def test_width_is_the_fewest_bits():
    assert [B.width(n) for n in (1, 2, 3, 50_257, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def test_token_files(spark, odd_docs):
    got = [r.asDict() for r in B.token_files(spark, odd_docs).orderBy("start").collect()]
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    at = 0
    for g, r, ids in zip(got, rows, plain([r.text for r in rows]), strict=True):
        ids = ids + [2]
        assert (g["doc_id"], g["start"], g["n_tokens"]) == (r.doc_id, at, len(ids))
        assert np.frombuffer(g["ids"], "<u4").tolist() == ids
        at += len(ids)


class TaskOf:
    """Stands for a table; gives the function that its tasks would run."""

    def __init__(self, df):
        self.sparkSession = df.sparkSession

    def mapInArrow(self, run, schema):
        return run


def test_reading_holds_no_ids_of_segments_that_are_done(spark, words, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(words[i:i + 300])) for i in range(200)], "doc_id long, text string")
    path = B.write_token_files(docs, str(tmp_path / "files"), segment_ids=2000)
    monkeypatch.setattr(B, "map_batches", lambda df, *a: C.map_batches(TaskOf(df), *a))
    run = B.read_token_files(spark, path)
    segs = spark.read.schema(B.SEGMENTS).parquet(path)
    batches = segs.select("shard", "first_id", "payload", "doc_ids", "doc_lengths").toArrow().to_batches()

    def read():
        return sum(4 * sum(b.column("n_tokens").to_pylist()) for b in run(iter(batches)))

    size = read()
    tracemalloc.start()
    try:
        read()
        before = tracemalloc.get_traced_memory()[0]
        for _ in range(5):
            assert read() == size
        assert tracemalloc.get_traced_memory()[0] - before < size / 2
    finally:
        tracemalloc.stop()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=20))
def test_binary_values_are_cut_at_the_ends(lens):
    flat = np.arange(sum(lens), dtype=np.uint32)
    got = B.binary_values(flat, np.cumsum(np.asarray(lens, np.int64))).cast(pa.binary()).to_pylist()
    assert b"".join(got) == flat.astype("<u4").tobytes() and [len(x) // 4 for x in got] == lens


def test_no_documents(spark, no_docs):
    assert B.token_files(spark, no_docs).count() == 0
    assert P.pack(no_docs).count() == 0


def test_pieces_cover_every_document_and_fill_windows(odd_docs):
    pieces = P.pack(odd_docs, window=256, grain=32)
    rows = pieces.collect()
    total = sum(len(x) + 1 for x in plain([r.text for r in odd_docs.collect()]))
    assert sum(r.length for r in rows) == total
    by_seq = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(r.ids)
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_seq) == list(range(-(-total // 256)))
    for k, parts in by_seq.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or k == max(by_seq)
    # texts come back from the pieces
    want = sorted(map(tuple, (x + [1] for x in plain([r.text for r in odd_docs.collect() if r.doc_id == 6]))))
    got = b"".join(r.ids for r in sorted((r for r in rows if r.doc_id == 6), key=lambda r: r.start))
    assert [tuple(np.frombuffer(got, "<u4").tolist())] == want


def test_sequences_are_padded_but_for_powers_of_two(odd_docs):
    seqs = P.sequences(P.pack(odd_docs, window=256, grain=32), window=256).collect()
    for s in seqs:
        assert len(s.ids) // 4 == (256 if s.n_tokens & (s.n_tokens - 1) else s.n_tokens)


def round_robin(tokens, q, grain, unit):
    """Deficit round-robin, one grain after the other."""
    left, deficit, order, done = [t // grain for t in tokens], [0] * len(tokens), [], [0] * len(tokens)
    while any(left):
        for s in range(len(tokens)):
            deficit[s] += q[s]
            while left[s] and deficit[s] >= grain * unit:
                deficit[s] -= grain * unit
                order.append((s, done[s]))
                done[s] += 1
                left[s] -= 1
    return order


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=5), st.data())
def test_schedule_is_deficit_round_robin(tokens, data):
    shares = data.draw(st.lists(st.integers(0, 9), min_size=len(tokens), max_size=len(tokens)))
    plan = P.Schedule.of(tokens, shares, window=256, grain=64)
    plan.q = np.maximum(plan.q, 2000)      # a tiny quantum only makes the loop long
    order = round_robin(tokens, plan.q.tolist(), 64, P.UNIT)
    s, j = (np.array([o[i] for o in order], np.int64) for i in (0, 1))
    assert plan.place(s, j).tolist() == [64 * i for i in range(len(order))]


def test_windows_follow_the_targets():
    plan = P.Schedule.of([64_000, 64_000, 128_000], [1, 1, 2], window=2048, grain=64)
    place = [(int(p), s) for s in range(3) for p in plan.place(np.full(int(plan.full[s]), s), np.arange(plan.full[s]))]
    for lo in range(0, 250_000, 2048):
        n = [sum(1 for p, s in place if s == k and lo <= p < lo + 2048) for k in range(3)]
        assert abs(n[2] - 16) <= 2 and abs(n[0] - n[1]) <= 2


def test_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_SOURCES", 3)
    rows = [(i, f"words of number {i} " * (i % 7 + 1), ["big", "big", "big", "mid", "mid", None, "a", "b", "c"][i % 9], i)
            for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rest int")
    assert P.own_queues(docs, "source") == ["big", "mid"]
    pieces = P.pack(docs, targets={"big": 1, "mid": 2, "a": 1, "b": 1}, window=256, grain=32).collect()
    ids, seqs = {}, {}
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(ids.setdefault(r.doc_id, b"")) // 4 and r.source == rows[r.doc_id][2]
        ids[r.doc_id] += r.ids
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = plain([r[1] for r in rows])
    assert {d: np.frombuffer(x, "<u4").tolist() for d, x in ids.items()} == {i: x + [1] for i, x in enumerate(want)}
    for k, parts in seqs.items():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and (ends[-1] == 256 or k == max(seqs))


def test_places_do_not_depend_on_the_slice():
    plan = P.Schedule.of([5000, 70, 333], [3, 1, 2], window=256, grain=64)
    s = np.repeat(np.arange(3), plan.full)
    j = np.concatenate([np.arange(n) for n in plan.full])
    assert plan.place(s, j, cells=1).tolist() == plan.place(s, j).tolist()
