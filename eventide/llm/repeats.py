"""Periodic runs of words (operator 13): maximal pairs from the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q that repeats
at least ``exponent`` times, has ``min_words`` words or more, and that no
neighbouring word extends.  For a run of length L that starts at i, the
suffixes at i and i + q share exactly l = L - q words and the words to their
left differ: they are a *maximal pair* of distance q.  So the runs are the
maximal pairs whose distance and common length satisfy
``(exponent - 1) * q <= l`` and ``q + l >= min_words``; nothing is extended.

The pairs come from a bottom-up walk over the LCP-interval tree of the
suffix array.  Every interval of l common words holds its occurrences in text
order, each with the class of its left word.  When two children of an
interval meet, each occurrence of the smaller child is held against its
neighbours in the larger one; a pair of two left-word classes is maximal.
Neighbours are enough: an occurrence between i and i + q would give the
stretch a smaller period.  Occurrences of l words at a distance of l / 2 or
less form one progression, so this finds each run once, in n log n steps,
without listing the pairs of an interval.

A suffix array is needed only where it can matter: l is at least
``min_words * (exponent - 1) / exponent``, so documents in which no n-gram of
that length occurs twice (by a rolling hash, which misses none) have no run.

Defined cases: null and empty texts have no words and no run; very long texts
are handled whole (memory in proportion to the text); repeated rows and ids
are texts of their own, a null id stays null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, map_stream, mix64, text_col
from .tokens import text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN_WORDS, EXPONENT = 24, 3


def repeated_grams(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Per document: does some ``size``-gram occur twice in it?  Equal grams are never missed."""
    docs = len(starts) - 1
    out = np.zeros(docs, bool)
    if len(words) < size + 1:
        return out
    with np.errstate(over="ignore"):
        grams, have, base, power, bit = None, 0, U64(0x9E3779B97F4A7C15), mix64(words.astype(U64) + U64(1)), 1
        # grams of 1, 2, 4, ... words, put together to the size asked for
        step = base
        while True:
            if size & bit:
                if grams is None:
                    grams, have = power, bit
                else:
                    n = len(words) - have - bit + 1
                    grams, have = grams[:n] * step + power[have:have + n], have + bit
            bit <<= 1
            if bit > size:
                break
            half = bit >> 1
            n = len(words) - bit + 1
            power = power[:n] * step + power[half:half + n]
            step = step * step
    doc = np.repeat(np.arange(docs), np.diff(starts))[:len(grams)]
    inside = np.arange(len(grams)) + size <= starts[doc + 1]
    doc, grams = doc[inside], grams[inside]
    key = mix64(grams) ^ mix64(doc.astype(U64) + U64(1))
    order = np.argsort(key, kind="stable")
    twin = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    out[doc[order][1:][twin]] = True
    return out


def suffix_array(words: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order, document by document: prefix doubling on the groups still tied.

    ``doc`` numbers the document of every word, ``ends`` is where it ends.
    """
    n = len(words)
    sa = np.lexsort((words, doc))
    head = np.ones(n, bool)
    head[1:] = (doc[sa][1:] != doc[sa][:-1]) | (words[sa][1:] != words[sa][:-1])
    h = 1
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    single = head & np.append(head[1:], True)
    slots = np.flatnonzero(~single)
    while len(slots):
        at = sa[slots]
        nxt = at + h
        follow = np.where(nxt < ends[at], rank[np.minimum(nxt, n - 1)] + 1, 0)
        order = np.lexsort((follow, rank[at]))
        at, follow = at[order], follow[order]
        old = rank[at]
        head = np.ones(len(at), bool)
        head[1:] = (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])
        sa[slots] = at
        rank[at] = np.maximum.accumulate(np.where(head, slots, 0))
        slots = slots[~(head & np.append(head[1:], True))]
        h *= 2
    return sa


def common_prefixes(words: list[int], doc: list[int], ends: list[int], sa: list[int]) -> list[int]:
    """lcp[r]: words that suffix r shares with the suffix before it in the order (0 across documents)."""
    n = len(sa)
    rank = [0] * n
    for r, i in enumerate(sa):
        rank[i] = r
    lcp, h = [0] * n, 0
    for i in range(n):
        r = rank[i]
        j = sa[r - 1] if r else -1
        if j < 0 or doc[j] != doc[i]:
            h = 0
            continue
        most = ends[i] - (i if i > j else j)
        while h < most and words[i + h] == words[j + h]:
            h += 1
        lcp[r] = h
        if h:
            h -= 1
    return lcp


def maximal_pairs(sa: list[int], lcp: list[int], left: list[int], min_words: int = MIN_WORDS,
                  exponent: int = EXPONENT):
    """(start, length, period) of the maximal pairs that satisfy the length constraints."""
    reach, least = exponent - 1, -(-min_words * (exponent - 1) // exponent)

    def meet(a: list[int], b: list[int], depth: int) -> list[int]:
        """Join two children of an interval of ``depth`` common words."""
        small, large = (a, b) if len(a) < len(b) else (b, a)
        most = depth // reach
        for x in small:
            k = bisect_left(large, x)
            for y in large[max(0, k - 1):k + 1]:
                q = x - y if x > y else y - x
                if q <= most and q + depth >= min_words and left[x] != left[y]:
                    found.append((min(x, y), q + depth, q))
        for x in small:
            if x > large[-1]:
                large.append(x)
            else:
                insort(large, x)
        return large

    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    last: list[int] = []
    for r, i in enumerate(sa):
        l = lcp[r] if r else 0      # noqa: E741
        while stack and stack[-1][0] > l:
            depth, held = stack.pop()
            last = meet(held, last, depth)
        if l >= least:
            stack.append((l, last))
        last = [i]
    while stack:
        depth, held = stack.pop()
        last = meet(held, last, depth)
    return found


def runs_of(texts: list[list[int]], min_words: int = MIN_WORDS, exponent: int = EXPONENT):
    """For every text (as word numbers) its runs as sorted (start, length, period)."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.fromiter((w for t in texts for w in t), np.int64, int(starts[-1]))
    least = -(-min_words * (exponent - 1) // exponent)
    todo = np.flatnonzero(repeated_grams(flat, starts, least))
    if not len(todo):
        return out
    sizes = sizes[todo]
    words = np.concatenate([flat[starts[t]:starts[t + 1]] for t in todo])
    begin = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(todo)), sizes)
    ends = (begin + sizes)[doc]
    left = np.empty_like(words)
    left[1:] = words[:-1]
    left[begin] = -1
    sa = suffix_array(words, doc, ends).tolist()
    lcp = common_prefixes(words.tolist(), doc.tolist(), ends.tolist(), sa)
    best: dict[tuple[int, int], int] = {}
    for start, length, q in maximal_pairs(sa, lcp, left.tolist(), min_words, exponent):
        key = (start, length)
        if q < best.get(key, length):
            best[key] = q
    for (start, length), q in best.items():
        d = doc[start]
        out[todo[d]].append((int(start - begin[d]), length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words, without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  min_words: int = MIN_WORDS, exponent: int = EXPONENT) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period, in words), collapsed.

    ``collapsed`` is the text's words joined by one space, without the words
    that a run repeats after its first period.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("d"), text_col(text).alias("t"))

    def run(batches):
        for b in batches:
            for part in text_slices(b, 1, 4_000_000):
                number: dict[str, int] = {}
                words = [WORD.findall(t) for t in part.column(1).to_pylist()]
                found = runs_of([[number.setdefault(w, len(number)) for w in ws] for ws in words],
                                min_words, exponent)
                yield {"doc_id": part.column(0).to_pylist(), "n_words": [len(w) for w in words],
                       "runs": [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found],
                       "collapsed": [" ".join(collapse(w, r)) for w, r in zip(words, found)]}

    return map_stream(rows, run, "doc_id long, n_words long, "
                      "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def greatest(runs: str = "runs"):
    """The run with the greatest length / period (ties: smallest start, then period); null without runs."""
    better = lambda best, x: F.when(                          # noqa: E731
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    kind = "struct<start:long,length:long,period:long>"
    return F.aggregate(F.col(runs), F.lit(None).cast(kind), better)
