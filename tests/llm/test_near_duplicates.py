import collections
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import icws as W
from eventide.llm import pairs, rabitq
from eventide.llm.common import table

SF_SMALL = "/root/testdata/sf0.001"


def brute(docs):
    """row -> (links, smallest row of the group) by exact weighted Jaccard similarity of all pairs."""
    bags = []
    for t in docs:
        w = [x for x in (v.lower().strip(W._STRIP) for v in (t or "").split()) if x]
        k = min(5, len(w))
        bags.append(collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else collections.Counter())
    df = collections.Counter(s for b in bags for s in b)
    n = len(bags)
    idf = {s: 1 + math.log((n + 1) / (c + 1)) / math.log(n + 1) for s, c in df.items()}
    total = [sum(idf[s] * c for s, c in b.items()) for b in bags]
    links = [set() for _ in bags]
    for a in range(n):
        for b in range(a):
            both = sum(idf[s] * min(c, bags[b][s]) for s, c in bags[a].items() if s in bags[b])
            if both and both / (total[a] + total[b] - both) >= 0.8 - 1e-9:
                links[a].add(b)
                links[b].add(a)
    return links


@pytest.fixture(scope="module")
def near_docs(spark, words):
    r = random.Random(11)
    text = lambda n: [r.choice(words) for _ in range(n)]
    passage = text(30)
    docs = [None, "", "one two", "One, two!", " . "]
    for size in (40, 80, 200):
        for _ in range(4):
            base = text(size)
            docs.append(" ".join(base))
            for edits in (0, 1, 2, 5, 12):
                copy = list(base)
                for _ in range(edits):
                    copy[r.randrange(size)] = r.choice(words)
                docs.append(" ".join(copy))
    docs += [" ".join(text(60) + passage + text(60)) for _ in range(12)]
    docs += ["again and again " * 40, "again and again " * 41, "again and again " * 60]
    rows = [(i, t, "x", 1) for i, t in enumerate(docs)]
    return docs, spark.createDataFrame(rows, "doc_id long, text string, key string, cid int").repartition(4)


def test_near_duplicates_equal_brute_force(near_docs):
    docs, df = near_docs
    links = brute(docs)
    got = {r.doc_id: r for r in W.near_duplicates(df).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: len(x) for i, x in enumerate(links)}
    for i, x in enumerate(links):
        assert all(got[j].class_id == got[i].class_id for j in x)
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[i].class_id == min(seen) and got[i].n_group == len(seen)


def test_small_blocks_give_the_same_links(near_docs, monkeypatch):
    docs, df = near_docs
    whole = {tuple(r) for r in W.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()}
    cut = pairs.in_block_pairs
    monkeypatch.setattr(W, "in_block_pairs", lambda rows, keys, row_id, block: cut(rows, keys, row_id, 2))
    assert {tuple(r) for r in W.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()} == whole


def test_null_ids_sort_last_in_their_group(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, text), (5, text), (7, text), (7, text), (None, "a b c d e f"), (None, "a b c d e f")],
                                 "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.n_links, r.n_group) for r in W.near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5, 3, 4), (7, 5, 3, 4), (7, 5, 3, 4), (None, 5, 3, 4), (None, None, 1, 2), (None, None, 1, 2)]
    assert sorted(((r.doc_id, r.text) for r in W.deduplicated(docs).collect()), key=str) == [(5, text), (None, "a b c d e f")]


def test_odd_documents(odd_docs, no_docs):
    rows = W.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = collections.defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert [r.n_links for r in of[4]] == [3, 3] and of[5][0].class_id == of[12][0].class_id == 4
    assert of[1][0].n_links == of[2][0].n_links == of[3][0].n_links == 0
    assert of[8][0].class_id == 7
    kept = W.deduplicated(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and not {5, 8, 12} & set(ids) and {1, 2, 3, 6, 7, 9, 10, None} <= set(ids)
    assert W.near_duplicates(no_docs).count() == 0 and W.deduplicated(no_docs).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2 ** 52 - 1), min_size=1, max_size=200, unique=True), st.data())
def test_packed_hashes_round_trip(h, data):
    h = np.array(sorted(h), np.uint64)
    assert (W.unpack_sorted(W.pack_sorted(h)) == h).all()
    c = np.array(data.draw(st.lists(st.integers(1, 2 ** 40), min_size=len(h), max_size=len(h))))
    assert (W.unpack_counts(W.pack_counts(c), len(c)) == c).all()


def test_samples_agree_as_often_as_sets_are_similar():
    r = np.random.default_rng(1)
    h = r.integers(0, 2 ** 52, 400).astype(np.uint64)
    w1, w2 = r.uniform(0.5, 4, 400), r.uniform(0.5, 4, 400)
    w2[:300] = w1[:300]
    sig = W.icws(np.concatenate([h, h]), np.concatenate([w1, w2]), np.array([400, 400]), 2000)
    j = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((sig[0] == sig[1]).mean() - j) < 4 * (j * (1 - j) / 2000) ** 0.5


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in pairs.components(edges).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 200: 100, 300: 100}
    assert pairs.components(edges.filter("false")).count() == 0


# --- vectors ---------------------------------------------------------------

def test_estimate_is_unbiased_and_bounded():
    r = np.random.default_rng(3)
    d, errors, inside = 64, [], 0
    for seed in range(300):
        x = r.standard_normal((2, d))
        x[1] = 0.8 * x[0] + 0.6 * x[1]
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        turned, code, factor = rabitq.encode(x, seed)
        est, half = rabitq.estimate(code[:1], factor[:1], turned[1:])
        errors.append(est[0, 0] - x[0] @ x[1])
        inside += abs(errors[-1]) <= half[0, 0]
    assert abs(np.mean(errors)) < 4 * np.std(errors) / 300 ** 0.5
    assert inside >= 295


def vectors(spark):
    r = np.random.default_rng(9)
    rows, i = [], 0
    for label in (1, 2, None):
        for _ in range(12):
            base = r.standard_normal(64)
            for noise in (0.0, 0.0, 0.02, 0.05, 0.1, 0.2, 0.4):
                v = base + noise * r.standard_normal(64)
                rows.append((i, [float(x) for x in v * r.uniform(0.1, 50)], label, "x"))
                i += 1
    odd = [None, [], [0.0] * 64, [None] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1.0, 2.0], [-0.0, 2.0]]
    rows += [(1000 + k, v, 1, "y") for k, v in enumerate(odd)]
    rows += [(5, rows[5][1], rows[5][2], "x"), (2000, [0.0, 2.0], 1, "y")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, copies string")


def test_near_vectors_against_brute_force(spark):
    df = vectors(spark)
    rows = df.collect()
    got = rabitq.near_vectors(df).collect()
    assert len(got) == len(rows)

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    u = [unit(r.embedding) for r in rows]
    want = collections.Counter()
    for a in range(len(rows)):
        for b in range(a):
            if (u[a] is not None and u[b] is not None and len(u[a]) == len(u[b]) and rows[a].label is not None
                    and rows[a].label == rows[b].label and u[a] @ u[b] >= 0.93):
                want[a] += 1
                want[b] += 1
    most = collections.defaultdict(int)
    for k, r in enumerate(rows):
        most[r.vec_id] = max(most[r.vec_id], want[k])
    assert all(r.n_links <= most[r.vec_id] for r in got)
    total = sum(want.values())
    assert total > 300 and sum(r.n_links for r in got) >= 0.95 * total
    assert all(r.component_id == r.vec_id for r in got if 1000 <= r.vec_id < 1006)
    assert rabitq.near_vectors(df.filter("false")).count() == 0


def test_recall_on_the_small_table(spark):
    df = table(spark, SF_SMALL, "embeddings")
    got = {r.vec_id: r.n_links for r in rabitq.near_vectors(df, threshold=0.6).collect()}
    rows = df.filter("label is not null").collect()
    x = np.array([r.embedding for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r.label for r in rows])
    links = (x @ x.T >= 0.6) & (label[:, None] == label[None, :])
    np.fill_diagonal(links, False)
    assert sum(got.values()) >= 0.9 * links.sum()


def pairs_between(low, high, n, dim=64):
    """n pairs of unit vectors (a, b) whose cosines lie in low..high."""
    r = np.random.default_rng(17)
    a, b = r.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = r.uniform(low, high, (n, 1))
    return a, c * a + np.sqrt(1 - c * c) * b


@pytest.mark.parametrize("bits", [8, 14, 17, 21])
def test_pairs_at_the_threshold_meet_as_planned(bits):
    """Labels so large that a key has ``bits`` bits."""
    got, tables = rabitq.plan(8 << bits, 0.93, 0.99)
    assert got == bits
    a, b = pairs_between(0.93, 0.9301, 10_000)
    meet = (rabitq.table_keys(a, bits, tables) == rabitq.table_keys(b, bits, tables)).any(axis=1)
    assert meet.mean() >= 0.985


@pytest.mark.parametrize("bits", [14, 17, 21])
def test_links_at_the_threshold_are_found_in_large_labels(spark, monkeypatch, bits):
    planned = rabitq.plan
    monkeypatch.setattr(rabitq, "plan", lambda largest, threshold, recall: planned(8 << bits, threshold, recall))
    n = 500
    a, b = pairs_between(0.9301, 0.94, n)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([a, b]))]
    got = rabitq.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == 2 * n and all(r.n_links in (0, 1) and r.component_id in (r.vec_id, r.vec_id - n) for r in got)
    assert sum(r.n_links for r in got) >= 0.97 * 2 * n
