"""Toxicity score: a bidirectional GRU with attention pooling, trained in numpy (operator 3).

A word's input is a hashed word embedding, the mean of hashed embeddings of
its character 3- to 5-grams, and two evidence values: how surely the word,
and its most telling n-gram, lean to toxic training documents (log odds of
document frequencies).  A bidirectional gated recurrent
network reads windows of ``WINDOW`` words that overlap by ``WINDOW - STRIDE``;
attention pools its states into one logit a window.  A document's score is a
logistic function, fitted on training documents, of its highest window and
its strongest evidence.

Labels belong to documents, so training takes from each toxic document the
window with the most evidence as a witness, and from each clean one its most
misleading window and others.  The evidence a training document is read
with comes from the other ``PARTS - 1`` parts of the training documents, and
one part is kept out of the steps to fit the logistic function.

The training sample is bounded: at most ``MAX_DOCS`` labelled documents of
each class, those with the smallest hash of doc_id, among rows whose
``crc32(doc_id) mod 5`` is not 0.  All texts are scored whole.

Defined cases: a null or empty text, or one without words, scores 0; a null
doc_id is not held out; without labels of both classes every score is 0;
repeated rows are scored alike; an empty table gives no row.
"""

from __future__ import annotations

import math
import string

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordTable, map_batches, mix64, per_worker, ship, spans_index, text_col
from .tokens import groups_of

MAX_DOCS, WINDOW, STRIDE = 1500, 64, 48
HIDDEN, DIM, ATTEND = 8, 8, 8
EMBED_BITS = 14
EPOCHS, LEAST_STEPS, BATCH, RATE, SEED = 5, 150, 128, 0.01, 11
EMBED_RATE, EMBED_DECAY, STUTTER = 0.05, 0.002, 0.15
GRAMS = (3, 4, 5)
FOLDS, PARTS = 5, 4
_STRIP = string.punctuation + "«»“”„‘’–—…¡¿"


def held_out(col) -> object:
    """crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def normal(word: str) -> str:
    return word.lower().strip(_STRIP)


class Features:
    """Hash features of normalised words: a word hash and the hashes of its character n-grams, word after word."""

    def __init__(self, words: list[str], step: int = 20_000):
        if len(words) > step:     # in parts: the temporary arrays are several times the result
            parts = [Features(words[i:i + step]) for i in range(0, len(words), step)]
            self.word, self.n_grams, self.gram = (np.concatenate([getattr(p, k) for p in parts])
                                                  for k in ("word", "n_grams", "gram"))
            return
        self.word = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words),
                                U64, len(words))
        # All words in one code-point array, each between boundary marks.
        text = "".join(f"\x02{w}\x03" for w in words)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        lens = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        first = np.cumsum(lens) - lens
        per = [np.maximum(0, lens - n + 1) for n in GRAMS]
        self.n_grams = sum(per)
        at = np.cumsum(self.n_grams) - self.n_grams
        self.gram = np.empty(int(self.n_grams.sum()), U64)
        with np.errstate(over="ignore"):
            for n, k in zip(GRAMS, per):
                place = spans_index(k)
                pos = np.repeat(first, k) + place
                h = np.full(len(pos), U64(n), U64)
                for i in range(n):
                    h = h * U64(0x9E3779B97F4A7C15) + code[pos + i]
                self.gram[np.repeat(at, k) + place] = mix64(h)
                at = at + k

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_grams)), self.n_grams)

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Embedding slots of words and n-grams."""
        mask = U64((1 << EMBED_BITS) - 1)
        return (self.word & mask).astype(np.int64), (self.gram & mask).astype(np.int64)


def lean(c1, c0, n1: int, n0: int) -> np.ndarray:
    """Log odds that a feature's documents are toxic, towards 0 by its 95 % bound, at most 3 either way."""
    c1, c0 = np.maximum(c1, 0) + 0.5, np.maximum(c0, 0) + 0.5
    odds = np.log(c1 / (n1 + 1)) - np.log(c0 / (n0 + 1))
    sure = np.maximum(0, np.abs(odds) - 1.64 * np.sqrt(1 / c1 + 1 / c0))
    return (np.sign(odds) * np.minimum(sure, 6) / 2).astype(np.float32)


def look_up(h: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values of hashes in a sorted table; 0 for a hash that is not there."""
    if not len(keys):
        return np.zeros(len(h), np.float32)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], np.float32(0))


def _by_word(value: np.ndarray, f: Features, how) -> np.ndarray:
    """Reduce a value per n-gram to one per word (0 for words without n-grams)."""
    out = np.zeros((len(f.n_grams), *value.shape[1:]), np.float32)
    has = f.n_grams > 0
    if has.any():
        starts = (np.cumsum(f.n_grams) - f.n_grams)[has]
        out[has] = how.reduceat(value, starts, axis=0)
    return out


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Parameters and passes; arrays are float32."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        d, h = 2 * DIM + 2, HIDDEN
        norm = lambda *s: r.standard_normal(s).astype(np.float32)
        self.p = {"word": norm(1 << EMBED_BITS, DIM) * 0.05, "gram": norm(1 << EMBED_BITS, DIM) * 0.05,
                  "wf": norm(d, 3 * h) / d ** 0.5, "wb": norm(d, 3 * h) / d ** 0.5,
                  "uf": norm(h, 3 * h) / h ** 0.5, "ub": norm(h, 3 * h) / h ** 0.5,
                  "bf": np.zeros(3 * h, np.float32), "bb": np.zeros(3 * h, np.float32),
                  "aw": norm(2 * h, ATTEND) / (2 * h) ** 0.5, "ab": np.zeros(ATTEND, np.float32),
                  "av": norm(ATTEND) / ATTEND ** 0.5, "ow": norm(2 * h) / (2 * h) ** 0.5,
                  "ob": np.zeros(1, np.float32)}
        self.evidence: tuple = ()    # (word lean, n-gram lean) by hash slot
        self.scale = np.array([1.0, 0.0, 0.0])   # logistic: highest window, strongest evidence, offset

    def inputs(self, f: Features, evidence: np.ndarray) -> np.ndarray:
        ws, gs = f.slots()
        mean = _by_word(self.p["gram"][gs], f, np.add) / np.maximum(1, f.n_grams)[:, None]
        return np.concatenate([self.p["word"][ws], mean, evidence], axis=1).astype(np.float32)

    def seen(self, f: Features) -> np.ndarray:
        """Evidence of words, from the tables of all training documents: word, strongest n-gram."""
        (wk, wv), (gk, gv) = self.evidence
        return np.stack([look_up(f.word, wk, wv), _by_word(look_up(f.gram, gk, gv), f, np.maximum)], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input part of both directions' gates, per word."""
        p = self.p
        return np.concatenate([x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]], axis=1)

    def run(self, gates: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; ``idx`` (windows x WINDOW) points into ``gates``."""
        p, h, (n, steps) = self.p, HIDDEN, idx.shape
        states = np.zeros((steps, n, 2 * h), np.float32)
        trace = {"f": [], "b": []}
        for name, col, order in (("f", 0, range(steps)), ("b", 3 * h, range(steps - 1, -1, -1))):
            u, s = p["u" + name], np.zeros((n, h), np.float32)
            for t in order:
                g = gates[idx[:, t], col:col + 3 * h]
                m = mask[:, t, None]
                zr = _sigmoid(g[:, :2 * h] + s @ u[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(g[:, 2 * h:] + (r * s) @ u[:, 2 * h:])
                new = s + m * z * (c - s)
                if keep:
                    trace[name].append((t, s, z, r, c, m))
                states[t, :, col // 3:col // 3 + h] = s = new
        a = np.tanh(states @ p["aw"] + p["ab"])
        e = np.where(mask.T, a @ p["av"], -1e9)
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        logit = pooled @ p["ow"] + p["ob"][0]
        return (logit, (states, a, alpha, pooled, trace)) if keep else logit

    def step(self, f: Features, evidence, idx, mask, y, weight, adam: dict) -> float:
        """One Adam step of the weighted cross-entropy over a batch of windows."""
        p, h = self.p, HIDDEN
        x = self.inputs(f, evidence)
        logit, (states, a, alpha, pooled, trace) = self.run(self.gates(x), idx, mask, True)
        prob = _sigmoid(logit)
        loss = -np.mean(weight * np.where(y, np.log(prob + 1e-7), np.log(1 - prob + 1e-7)))
        d_logit = ((prob - y) * weight / len(y)).astype(np.float32)
        g = {"ow": pooled.T @ d_logit, "ob": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * p["ow"]
        d_alpha = (states * d_pool[None]).sum(axis=2)
        d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=0))
        d_a = d_e[:, :, None] * p["av"] * (1 - a * a)
        flat_s, flat_a = states.reshape(-1, 2 * h), d_a.reshape(-1, ATTEND)
        g |= {"av": a.reshape(-1, ATTEND).T @ d_e.reshape(-1), "aw": flat_s.T @ flat_a, "ab": flat_a.sum(axis=0)}
        d_states = alpha[:, :, None] * d_pool[None] + d_a @ p["aw"].T
        d_gates = np.zeros((len(x), 6 * h), np.float32)
        for name, col in (("f", 0), ("b", 3 * h)):
            u = p["u" + name]
            du, carry = np.zeros_like(u), np.zeros((len(y), h), np.float32)
            for t, s, z, r, c, m in reversed(trace[name]):
                ds = carry + d_states[t, :, col // 3:col // 3 + h]
                dc = ds * m * z * (1 - c * c)
                dz = ds * m * (c - s) * z * (1 - z)
                drs = dc @ u[:, 2 * h:].T
                dr = drs * s * r * (1 - r)
                dzr = np.concatenate([dz, dr], axis=1)
                du[:, :2 * h] += s.T @ dzr
                du[:, 2 * h:] += (r * s).T @ dc
                carry = ds * (1 - m * z) + drs * r + dzr @ u[:, :2 * h].T
                np.add.at(d_gates[:, col:col + 3 * h], idx[:, t], np.concatenate([dzr, dc], axis=1))
            g["u" + name] = du
        df_, db_ = d_gates[:, :3 * h], d_gates[:, 3 * h:]
        g |= {"wf": x.T @ df_, "wb": x.T @ db_, "bf": df_.sum(axis=0), "bb": db_.sum(axis=0)}
        dx = df_ @ p["wf"].T + db_ @ p["wb"].T
        ws, gs = f.slots()
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], ws, dx[:, :DIM])
        np.add.at(g["gram"], gs, (dx[:, DIM:2 * DIM] / np.maximum(1, f.n_grams)[:, None])[f.owner])
        adam["t"] = adam.get("t", 0) + 1
        for k, v in g.items():
            m, s = adam.get(k, (0.0, 0.0))
            m, s = 0.9 * m + 0.1 * v, 0.999 * s + 0.001 * v * v
            adam[k] = (m, s)
            fix = (1 - 0.999 ** adam["t"]) ** 0.5 / (1 - 0.9 ** adam["t"])
            rate = RATE * (EMBED_RATE if k in ("word", "gram") else 1.0)
            p[k] -= (rate * fix * m / (np.sqrt(s) + 1e-7)).astype(np.float32)
            if k in ("word", "gram"):
                p[k] *= 1 - EMBED_DECAY
        return float(loss)


def windows(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of the overlapping windows that cover ``lens`` words each."""
    per = np.where(lens > 0, 1 + np.maximum(0, -((WINDOW - lens) // STRIDE)), 0)
    doc = np.repeat(np.arange(len(lens)), per)
    return doc, spans_index(per) * STRIDE


def window_index(rows: np.ndarray, lens: np.ndarray, doc: np.ndarray, first: np.ndarray):
    """(index of the words of each window in ``rows``' values, mask of real words)."""
    at = (np.cumsum(lens) - lens)[doc] + first
    size = np.minimum(WINDOW, lens[doc] - first)
    mask = np.arange(WINDOW)[None, :] < size[:, None]
    pos = np.minimum(at[:, None] + np.arange(WINDOW)[None, :], max(0, len(rows) - 1))
    return np.where(mask, rows[pos], 0), mask


def train(texts: list[str], toxic: list[int], seed: int = SEED) -> Network | None:
    """Fit on whole texts; None without both classes."""
    y = np.asarray(toxic, bool)
    n1, n0 = int(y.sum()), int((~y).sum())
    if not n1 or not n0:
        return None
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    rows_of = [np.fromiter((index.setdefault(normal(w), len(index)) for w in t.split()), np.int64) for t in texts]
    if not index:
        return None
    f = Features(list(index))
    part = rng.permutation(len(texts)) % PARTS
    g_keys = np.unique(f.gram)
    g_id = np.empty(len(f.gram), np.int32)
    for lo in range(0, len(g_id), 1 << 18):
        g_id[lo:lo + (1 << 18)] = np.searchsorted(g_keys, f.gram[lo:lo + (1 << 18)])
    sizes = (len(index), len(g_keys))
    counts = [np.zeros((PARTS, 2, n), np.int32) for n in sizes]     # words, n-grams: documents by part and class
    g_start = np.cumsum(f.n_grams) - f.n_grams
    for rows, label, k in zip(rows_of, y.astype(int), part):
        u = np.unique(rows)
        counts[0][k, label, u] += 1
        n = f.n_grams[u]
        counts[1][k, label, np.unique(g_id[np.repeat(g_start[u], n) + spans_index(n)])] += 1
    total = [c.sum(axis=0) for c in counts]
    evidence = np.empty((PARTS, len(index), 2), np.float32)     # without the part's own documents
    for k in range(PARTS):
        rest = int((y & (part != k)).sum()), int((~y & (part != k)).sum())
        words, grams = (lean(t[1] - c[k, 1], t[0] - c[k, 0], *rest) for t, c in zip(total, counts))
        evidence[k, :, 0], evidence[k, :, 1] = words, _by_word(grams[g_id], f, np.maximum)
    net = Network(seed)
    order = np.argsort(f.word)
    net.evidence = tuple((keys[v != 0], v[v != 0]) for keys, v in (
        (f.word[order], lean(total[0][1], total[0][0], n1, n0)[order]),
        (g_keys, lean(total[1][1], total[1][0], n1, n0))))
    lens = np.fromiter(map(len, rows_of), np.int64, len(rows_of))
    flat = np.concatenate(rows_of)
    doc, first = windows(lens)
    # Evidence of a window: its strongest words or n-grams.
    strength = evidence.max(axis=2)
    best = np.empty(len(doc), np.float32)
    for lo in range(0, len(doc), 4096):
        idx, mask = window_index(flat, lens, doc[lo:lo + 4096], first[lo:lo + 4096])
        v = np.where(mask, strength[part[doc[lo:lo + 4096]][:, None], idx], -9)
        best[lo:lo + 4096] = np.sort(v, axis=1)[:, -3:].clip(0).sum(axis=1) + v.max(axis=1)
    order = np.lexsort((-best, doc))
    lead = order[np.concatenate(([True], doc[order][1:] != doc[order][:-1]))]
    others = rng.permutation(np.flatnonzero(~y[doc]))[:2 * int((~y).sum())]
    chosen = np.unique(np.concatenate([lead, others]))
    chosen = chosen[part[doc[chosen]] != 0]
    if not len(chosen) or y[doc[chosen]].all() or not y[doc[chosen]].any():
        return None
    label = y[doc[chosen]]
    weight = np.where(label, 0.5 * len(label) / max(1, label.sum()), 0.5 * len(label) / max(1, (~label).sum()))
    adam: dict = {}
    # small samples get more rounds: about LEAST_STEPS steps
    rounds = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(chosen)))
    for _ in range(rounds):
        mixed = rng.permutation(len(chosen))
        for lo in range(0, len(mixed), BATCH):
            k = chosen[mixed[lo:lo + BATCH]]
            idx, mask = window_index(flat, lens, doc[k], first[k])
            # Some clean windows stutter (two of their words over and over), as junk pages do.
            for i in np.flatnonzero(~y[doc[k]] & (rng.random(len(k)) < STUTTER)):
                two = rng.integers(0, mask[i].sum(), 2)
                idx[i] = np.where(mask[i], idx[i, np.repeat(two, WINDOW // 2)], idx[i])
            # A word of two parts is two inputs: their evidence differs.
            used, inv = np.unique(idx * PARTS + part[doc[k]][:, None], return_inverse=True)
            sub = Subset(f, used // PARTS)
            ev = evidence[used % PARTS, used // PARTS]
            net.step(sub, ev, inv.reshape(idx.shape), mask, label[mixed[lo:lo + BATCH]],
                     weight[mixed[lo:lo + BATCH]], adam)
    top = np.full(len(texts), -np.inf)
    for s in range(PARTS):
        # the vocabulary in parts: an n-gram's embedding is gathered for each place it has
        gates = np.concatenate([net.gates(net.inputs(Subset(f, rows), evidence[s, rows])) for rows in
                                np.array_split(np.arange(len(index)), 1 + len(index) // 10_000)])
        mine = np.flatnonzero(part[doc] == s)
        for lo in range(0, len(mine), 2048):
            k = mine[lo:lo + 2048]
            idx, mask = window_index(flat, lens, doc[k], first[k])
            np.maximum.at(top, doc[k], net.run(gates, idx, mask))
    fresh = np.isfinite(top) & (part == 0)
    strongest = np.array([strength[k, r].max() if len(r) else 0 for k, r in zip(part, rows_of)])
    net.scale = logistic(np.stack([top, strongest], axis=1)[fresh], y[fresh])
    return net


class Subset(Features):
    """The features of some words of another set."""

    def __init__(self, f: Features, rows: np.ndarray):
        self.word, self.n_grams = f.word[rows], f.n_grams[rows]
        starts = (np.cumsum(f.n_grams) - f.n_grams)[rows]
        self.gram = f.gram[np.repeat(starts, self.n_grams) + spans_index(self.n_grams)]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Slopes (not negative) and offset of P(y | columns of x), by damped Newton steps with a small ridge."""
    a = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(float)
    w = prior = np.eye(a.shape[1])[0]

    def loss(w):
        return np.logaddexp(0, np.where(y, -1, 1) * (a @ w)).sum() + ridge / 2 * ((w - prior) ** 2).sum()

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)),
                               a.T @ (p - y) + ridge * (w - prior))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if size * np.abs(step).max() < 1e-6:
            break
    return np.append(np.maximum(w[:-1], 0.0), w[-1])


def word_gates(net: Network, words: list[str]) -> np.ndarray:
    """Per word: the input part of both directions' gates, and its evidence."""
    if not words:
        return np.zeros((0, 6 * HIDDEN + 1), np.float32)
    f = Features([normal(w) for w in words])
    evidence = net.seen(f)
    return np.concatenate([net.gates(net.inputs(f, evidence)), evidence.max(axis=1, keepdims=True)], axis=1)


def score_texts(net: Network | None, texts: list[str], table: WordTable) -> np.ndarray:
    """Document scores; every overlapping window of every text is read."""
    out = np.zeros(len(texts))
    if net is None:
        return out
    split = [t.split() for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    if not lens.sum():
        return out
    rows = table.look_up([w for s in split for w in s])
    gates = table.data
    doc, first = windows(lens)
    top = np.full(len(texts), -np.inf)
    for lo in range(0, len(doc), 2048):
        idx, mask = window_index(rows, lens, doc[lo:lo + 2048], first[lo:lo + 2048])
        np.maximum.at(top, doc[lo:lo + 2048], net.run(gates, idx, mask))
    has = lens > 0
    strongest = np.maximum.reduceat(gates[rows, -1], (np.cumsum(lens) - lens)[has])
    out[has] = 1 / (1 + np.exp(-np.clip(net.scale[0] * top[has] + net.scale[1] * strongest + net.scale[2],
                                        -500, 500)))
    return out


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str,
                    max_docs: int) -> DataFrame:
    """(t, y): at most ``max_docs`` labelled documents of each class, never a held-out one."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(label).cast("int").alias("y"))
             .withColumn("_order", F.xxhash64("_id")))
    few = None
    for value in (0, 1):
        part = known.filter(F.col("y") == value).orderBy("_order", "_id").limit(max_docs)
        few = part if few is None else few.union(part)
    # at most 2 * max_docs ids: a proven bound for the broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_col(text).alias("t"))
    return (rows.join(F.broadcast(few), "_id").dropDuplicates(["_id"]).orderBy("_order", "_id")
            .limit(2 * max_docs).select("t", "y"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        max_docs: int = MAX_DOCS) -> Network | None:
    """Train on the bounded sample, on the driver; class shares are those of all training labels."""
    rows = training_sample(docs, labels, id_col, text, label, max_docs).collect()
    net = train([r.t for r in rows], [r.y for r in rows])
    if net is not None:
        mine = F.col(label)
        n1, n0 = (labels.filter(mine.isin(0, 1) & ~held_out(F.col("doc_id")))
                  .agg(F.sum(mine.cast("long")), F.sum(1 - mine.cast("long"))).first())
        y1 = sum(r.y for r in rows)
        net.scale[-1] += math.log(n1 / n0) - math.log(y1 / (len(rows) - y1))
    return net


def _scorer(docs: DataFrame, net: Network | None):
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)   # about 4 MB, whatever the input

    def run(texts: list[str]) -> np.ndarray:
        model = shared.value
        table = per_worker(("toxicity", shared.id if hasattr(shared, "id") else id(model)),
                           lambda: WordTable(lambda w: word_gates(model, w), 200_000))
        out = np.zeros(len(texts))
        for lo, hi in groups_of([len(t) for t in texts], 1_500_000):
            out[lo:hi] = score_texts(model, texts[lo:hi], table)
        return out

    return run


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                       text_col(text).alias("t"))
    run = _scorer(docs, net)

    def one(b):
        s = run(b.column(2).to_pylist())
        return {"doc_id": b.column(0), "held_out": b.column(1), "score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return map_batches(rows, one, "doc_id long, held_out boolean, score double, predicted int", 1000)


def clean(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """The documents with a score below 0.5, all columns as they are."""
    import pyarrow as pa
    names = docs.columns
    at = names.index(text)
    run = _scorer(docs, net)

    def one(b):
        s = run([t or "" for t in b.column(at).to_pylist()])
        kept = b.filter(pa.array(s < 0.5))
        return dict(zip(names, kept.columns))

    return map_batches(docs, one, docs.schema, 1000)
