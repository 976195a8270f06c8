import collections
import math
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import quality as Q
from eventide.llm import resample as R
from eventide.llm import toxicity as X
from eventide.llm.common import WordTable


# --- toxicity ----------------------------------------------------------------

def labelled(words, n, seed):
    """Texts of several windows; a toxic one has two of a family of words in one of them."""
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(30, 260))]
        if i % 3 == 0:
            at = r.randrange(len(text) - 8)
            for k in (0, 5):
                text[at + k] = "vrok" + r.choice(["", "a", "en", "ish"]) + r.choice(["", ".", ","])
        texts.append(" ".join(text))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_held_out_accuracy(words):
    net = X.train(*labelled(words, 400, 1))
    texts, labels = labelled(words, 300, 2)
    table = WordTable(lambda w: X.word_gates(net, w))
    score = X.score_texts(net, texts, table)
    assert ((score >= 0.5) == np.array(labels, bool)).mean() >= 0.95
    # a score does not depend on the texts beside it
    alone = [X.score_texts(net, [t], table)[0] for t in texts[:5]]
    assert np.allclose(alone, score[:5], atol=1e-5)
    assert X.score_texts(net, ["", " \n "], table).tolist() == [0.0, 0.0]


def test_gradient(words):
    net, f = X.Network(3), X.Features(words[:30])
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 3
    r = np.random.default_rng(0)
    idx = r.integers(0, 30, (4, X.WINDOW))
    mask = np.arange(X.WINDOW)[None, :] < np.array([[64], [9], [30], [1]])
    y, ev = np.array([1, 0, 1, 0], bool), r.uniform(0, 1, (30, 2))

    def loss():
        p = X._sigmoid(net.run(net.gates(net.inputs(f, ev).astype(np.float64)), idx, mask))
        return -np.mean(np.where(y, np.log(p), np.log(1 - p)))

    before = {k: v.copy() for k, v in net.p.items()}
    adam = {}
    net.step(f, ev, idx, mask, y, np.ones(4), adam)
    net.p = before
    for k in ("uf", "ub", "wf", "wb", "aw", "av", "ow", "bf"):
        grad = adam[k][0] / 0.1
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-3
        up = loss()
        net.p[k][at] = old - 1e-3
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-3 - grad[at]) < 0.05 * abs(grad[at]) + 1e-4, k


def plain_logit(p, gates, words):
    """One window, word by word and number by number."""
    h = X.HIDDEN
    sig = lambda v: 1 / (1 + math.exp(-v))          # noqa: E731

    def direction(u, col, order):
        s, out = [0.0] * h, {}
        for w in order:
            g = gates[w][col:col + 3 * h]
            z = [sig(g[i] + sum(s[k] * u[k][i] for k in range(h))) for i in range(h)]
            r = [sig(g[h + i] + sum(s[k] * u[k][h + i] for k in range(h))) for i in range(h)]
            c = [math.tanh(g[2 * h + i] + sum(r[k] * s[k] * u[k][2 * h + i] for k in range(h))) for i in range(h)]
            s = [(1 - z[i]) * s[i] + z[i] * c[i] for i in range(h)]
            out[w] = s
        return out

    fore = direction(p["uf"].tolist(), 0, words)
    back = direction(p["ub"].tolist(), 3 * h, words[::-1])
    states = [fore[w] + back[w] for w in words]
    aw, ab, av = (p[k].tolist() for k in ("aw", "ab", "av"))
    e = [sum(av[j] * math.tanh(ab[j] + sum(s[k] * aw[k][j] for k in range(2 * h))) for j in range(len(av))) for s in states]
    share = [math.exp(v - max(e)) for v in e]
    pooled = [sum(a * s[k] for a, s in zip(share, states)) / sum(share) for k in range(2 * h)]
    return sum(x * w for x, w in zip(pooled, p["ow"].tolist())) + float(p["ob"][0])


def test_forward_pass_equals_a_plain_loop(words):
    net, f = X.Network(5), X.Features(words[:30])
    net.p = {k: v.astype(np.float64) * 2 for k, v in net.p.items()}
    net.p["ob"] = np.array([0.3])
    gates = net.gates(net.inputs(f, np.random.default_rng(1).uniform(0, 1, (30, 2))).astype(np.float64))
    lens = [12, 1, 7]
    idx = np.zeros((3, X.WINDOW), int)
    for i, n in enumerate(lens):
        idx[i, :n] = np.arange(n) + 3 * i
    got = net.run(gates, idx, np.arange(X.WINDOW)[None, :] < np.array(lens)[:, None])
    want = [plain_logit(net.p, gates.tolist(), list(range(3 * i, 3 * i + n))) for i, n in enumerate(lens)]
    assert np.allclose(got, want, atol=1e-4)


def test_windows_cover_every_word():
    lens = np.array([0, 1, 64, 65, 112, 113, 1000])
    doc, first = X.windows(lens)
    for i, n in enumerate(lens):
        starts = first[doc == i]
        seen = {w for s in starts for w in range(s, min(s + X.WINDOW, n))}
        assert seen == set(range(n)) and all(s < n for s in starts)
        assert all(b - a == X.STRIDE for a, b in zip(starts, starts[1:]))


def test_scores_of_documents(spark, words, odd_docs, no_docs):
    texts, labels = labelled(words, 240, 4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id long, toxic int")
    # held-out labels have no part in the model
    other = marks.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    a, b = (sorted(X.score(docs, X.fit(docs, m)).collect()) for m in (marks, other))
    assert a == b
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in a)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in a)
    net = X.fit(docs, marks)
    rows = X.score(odd_docs, net).collect()
    assert len(rows) == odd_docs.count() and all(r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    clean = X.clean(odd_docs, net)
    assert clean.schema == odd_docs.schema and clean.count() == sum(r.predicted == 0 for r in rows)
    # without labels of both classes nothing is toxic
    none = X.fit(docs, marks.filter("toxic = 0"))
    assert none is None and {r.score for r in X.score(odd_docs, none).collect()} == {0.0}
    assert X.score(no_docs, net).count() == 0


# --- quality -----------------------------------------------------------------

def plain_counts(text):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c#", "dé", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "ß<", "a b a b "]),
                max_size=60))
def test_base_counts(parts):
    text = "".join(parts)
    assert Q.measure(text)[:5] == plain_counts(text)


def test_em_finds_the_accuracies():
    r = np.random.default_rng(2)
    good = r.random(40_000) < Q.SHARE
    alarms = np.array([True] * 4 + [False] * 3)
    kind = r.integers(0, 4, len(good))
    votes = np.full((len(good), 7), Q.ABSTAIN)
    for k in range(4):
        votes[np.where(good, r.random(len(good)) < 0.003, kind == k), k] = Q.BAD
    for k in range(4, 7):
        right = r.random(len(good)) < 0.9
        votes[:, k] = np.where(r.random(len(good)) < 0.3, Q.ABSTAIN, np.where(right, good, ~good))
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    table = Q.fit_em(patterns, count.astype(float), alarms)
    verdict = Q.posterior(votes, Q.SHARE, table) >= 0.5
    assert (verdict == good).mean() > 0.95
    assert all(table[1, k, Q.BAD] < 0.01 and table[0, k, Q.BAD] > 0.15 for k in range(4))
    assert all(abs(table[1, k, Q.GOOD] - 0.9) < 0.05 for k in range(4, 7))


def test_verdicts(spark, odd_docs, no_docs):
    rows = Q.judged(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = collections.defaultdict(list)
    for d in odd_docs.collect():
        texts[d.doc_id].append(plain_counts(d.text or ""))
    for r in rows:
        assert tuple(r[f] for f in Q.FIELDS[:5]) in texts[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed) and 0 <= r.quality <= 1
    assert Q.judged(no_docs).count() == 0


# --- importance resampling -----------------------------------------------------

def test_weights_and_sample_equal_brute_force(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(i,) for i in (4, 100, 101, 102, 103, 104)], "doc_id long")
    chosen = {r.doc_id for r in target.collect()}
    rows = odd_docs.collect()
    raw, goal, per = collections.Counter(), collections.Counter(), []
    for r in rows:
        at, _ = R.buckets_of([r.text or ""], 512)
        per.append(at)
        raw.update(at.tolist())
        if r.doc_id in chosen:
            goal.update(at.tolist())
    n_raw, n_goal = sum(raw.values()), sum(goal.values())
    ratio = [math.log((goal[k] + 1) / (n_goal + 512)) - math.log((raw[k] + 1) / (n_raw + 512)) for k in range(512)]
    want = sorted((r.doc_id is not None, r.doc_id or 0, len(at), round(sum(ratio[k] for k in at), 6)) for r, at in zip(rows, per))
    got = R.weighted(odd_docs, target, buckets=512).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_grams, round(r.log_weight, 6)) for r in got) == want
    keyed = R.resample(odd_docs, target, k=10**6, buckets=512).collect()
    assert len(keyed) == len(rows)
    for k in (0, 1, 17, len(rows) - 1):
        some = R.resample(odd_docs, target, k=k, buckets=512).collect()
        assert len(some) == k
        assert sorted(r.sample_key for r in some) == sorted((r.sample_key for r in keyed if r.sample_key is not None))[-k or 10**6:]
    assert R.resample(no_docs, target).count() == 0


def test_every_target_text_counts(spark):
    """If all texts are target texts the two models are one, however many texts there are."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('w', id, ' x') as text")
    got = R.weighted(docs, docs.select("doc_id")).agg({"log_weight": "max", "*": "count"}).first()
    low = R.weighted(docs, docs.select("doc_id")).agg({"log_weight": "min"}).first()
    assert (got["max(log_weight)"], low[0], got["count(1)"]) == (0.0, 0.0, 20_500)


def test_kth_largest(spark):
    r = random.Random(4)
    values = [r.gauss(0, 10 ** r.randint(-6, 6)) for _ in range(3000)] + [1.5] * 500
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 500, 1999, 3499, 3500):
        assert R.kth_largest(df, "x", k) == ordered[k - 1]


def test_noise_is_gumbel(spark):
    g = np.array([r.g for r in spark.range(20_000).select(R.gumbel(__import__("pyspark").sql.functions.col("id")).alias("g")).collect()])
    assert abs(g.mean() - 0.5772) < 0.05 and abs(g.std() - math.pi / 6 ** 0.5) < 0.05


def test_target_words_win(spark, words):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(words[:200] if i % 2 else words[200:]) for _ in range(30))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.filter("doc_id % 2 = 1 and doc_id < 100").select("doc_id")
    got = {x.doc_id for x in R.resample(docs, target, fraction=0.5).collect()}
    assert len(got) == 150 and sum(i % 2 for i in got) >= 145
