"""Quality by weak supervision (operator 5).

Every rule votes good, votes bad or abstains (some only ever vote bad).  The
rules' accuracies are estimated without labels by expectation-maximisation
over the vote patterns of all documents, and a document's quality is the
posterior probability that it is good.

Rules meet only as patterns: at most 3 ** rules different ones, counted by
Spark, so the EM works on a small table whatever the corpus.

Base (``base_failed``): fewer than 20 words, or more than 30 % of the words
in 8-word windows that occur twice or more in the text.

Defined cases: a null text has no words and fails the base; repeated rows
get equal verdicts; an empty table gives no row, and a model of the priors.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_col
from .tokens import groups_of

# Words are runs without space, \t, \n, \v, \f and \r (ASCII white space only).
SPACES = " \t\n\x0b\x0c\r"
_TO_SPACE = str.maketrans(dict.fromkeys(SPACES[1:], " "))
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SYMBOLS = "#*$%&|<>"
NGRAM = 8
GOOD, BAD, ABSTAIN = 1, 0, -1
ALARMS = ("symbols", "duplicate_lines", "repeats", "capitals", "exclamation", "stutter")


def words_of(text: str) -> list[str]:
    if _OTHER_SPACE.search(text):      # str.split() would also split at these
        return [w for w in text.translate(_TO_SPACE).split(" ") if w]
    return text.split()


def repeated_words(ids: np.ndarray, n: int = NGRAM) -> int:
    """Words covered by windows of ``n`` words that occur twice or more (n a power of two)."""
    m = len(ids) - n + 1
    if m < 2:
        return 0
    g, size = ids, 1
    while size < n:          # number pairs of halves: exact, no hash
        pair = g[:-size].astype(np.int64) * (int(g.max()) + 1) + g[size:]
        g = np.unique(pair, return_inverse=True)[1]
        size *= 2
    twice = np.bincount(g)[g] >= 2
    if not twice.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and what only the rules use:
    distinct words, upper-case letters, exclamation marks, longest run of one word."""
    words = words_of(text)
    n = len(words)
    if not n:
        return (0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, 0, 0)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    dup = 0
    if "\n" in text:
        seen: set[str] = set()
        for line in text.split("\n"):
            if line.strip(SPACES):
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
    change = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
    joined = "".join(words)
    return (n, len(joined), sum(map(text.count, SYMBOLS)), dup, repeated_words(ids), len(number),
            capitals(joined), text.count("!"), int(np.diff(change).max()))


def capitals(text: str) -> int:
    low = text.lower()
    if len(low) != len(text):          # a capital whose lower case is two characters
        return sum(map(str.isupper, text))
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), "<u4") for x in (text, low))
    return int((a != b).sum())


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper",
          "n_exclaim", "longest_run", "n_lines", "n_ended")


def base_failed():
    n = F.col("n_words")
    return (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)


def _vote(good, bad):
    return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


def _alarm(bad):
    """A rule that only ever speaks against a document."""
    return F.when(bad, BAD).otherwise(ABSTAIN)


def rules() -> dict[str, object]:
    """Rule name -> vote column over the measures."""
    c = {f: F.col(f).cast("double") for f in FIELDS}
    n = F.greatest(c["n_words"], F.lit(1.0))
    chars = F.greatest(c["word_chars"], F.lit(1.0))
    lines = F.greatest(c["n_lines"], F.lit(1.0))
    return {
        "length": _vote((n >= 50) & (n <= 50_000), n < 20),
        "word_length": _vote((chars / n).between(3.5, 9.0), ~(chars / n).between(2.5, 14.0)),
        "sentences": _vote(c["n_ended"] >= 0.02 * n, (c["n_ended"] < 0.005 * n) & (n >= 50)),
        "variety": _vote(c["n_distinct"] / n > 0.3, (c["n_distinct"] / n < 0.08) & (n.between(100, 5_000))),
        "symbols": _alarm(c["n_symbols"] / n > 0.10),
        "duplicate_lines": _alarm(c["n_dup_lines"] > 0.5 * lines),
        "repeats": _alarm(c["n_repeat_words"] / n > 0.30),
        "capitals": _alarm(c["n_upper"] / chars > 0.5),
        "exclamation": _alarm(c["n_exclaim"] / n > 0.10),
        "stutter": _alarm(c["longest_run"] >= 8),
    }


def measured(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measures of every whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col(text).alias("t"))

    def run(b):
        texts = b.column(1).to_pylist()
        got = [measure(t) for t in texts]
        cols = dict(zip(FIELDS, zip(*got))) if got else {f: [] for f in FIELDS}
        cols["n_lines"] = [t.count("\n") + 1 for t in texts]
        cols["n_ended"] = [sum(map(t.count, (". ", "? ", ".\n", "?\n"))) + t.endswith((".", "?")) for t in texts]
        return cols | {"doc_id": b.column(0)}

    return map_batches(rows, run, "doc_id long, " + ", ".join(f"{f} long" for f in FIELDS), 500)


# What a vote is worth before any document is seen: P(vote bad, vote good | class).
START = {"alarm": ((0.25, 0.75), (0.004, 0.996)), "two_sided": ((0.3, 0.7), (0.05, 0.95))}


CONTRAST, SHARE = 50.0, 0.85


def fit_em(votes: np.ndarray, count: np.ndarray, alarms: np.ndarray, rounds: int = 500, share: float = SHARE,
           strength: float = 100.0) -> np.ndarray:
    """Table [class, rule, vote bad or good] by expectation-maximisation, for a given share of good documents.

    ``votes``: patterns x rules in {-1, 0, 1}; ``alarms`` marks the rules
    that only vote bad: their rate is that of going off among all documents
    of a class, the others' that of bad among votes cast.
    ``START`` is kept as a prior worth ``strength`` documents.  Bad documents
    are of several kinds that set off different alarms; ``CONTRAST`` keeps EM
    from taking the largest kind for the whole class and the others for good.
    """
    base = np.stack([np.array(START["alarm" if a else "two_sided"]) for a in alarms], axis=1)
    table = base.copy()
    at = np.where(alarms[None, :] & (votes < 0), GOOD, votes)
    for _ in range(rounds):
        good = posterior(votes, share, table)
        new = base * strength
        for v in (BAD, GOOD):
            hit = (at == v) * count[:, None]
            new[1, :, v] += (hit * good[:, None]).sum(axis=0)
            new[0, :, v] += (hit * (1 - good)[:, None]).sum(axis=0)
        new /= new.sum(axis=2, keepdims=True)
        # An alarm stays an alarm: at the rate it goes off, at least CONTRAST times likelier if bad.
        for r in np.flatnonzero(alarms):
            if new[1, r, BAD] * CONTRAST > new[0, r, BAD]:
                rate = share * new[1, r, BAD] + (1 - share) * new[0, r, BAD]
                new[0, r, BAD] = min(0.9, rate / (share / CONTRAST + 1 - share))
                new[1, r, BAD] = new[0, r, BAD] / CONTRAST
                new[:, r, GOOD] = 1 - new[:, r, BAD]
        done = np.abs(new - table).max() < 1e-9
        table = new
        if done:
            break
    return table


def posterior(votes: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """P(good | votes cast); an abstention, also an alarm's silence, says nothing.

    (Alarms exclude each other: junk is of one kind.  To count their silence
    as independent good votes would let it outvote the one that went off.)
    """
    odds = np.log(table[1]) - np.log(table[0])
    x = np.where(votes >= 0, odds[np.arange(votes.shape[1])[None, :], np.maximum(votes, 0)], 0.0).sum(axis=1)
    return 1 / (1 + np.exp(-np.clip(x + np.log(share) - np.log1p(-share), -500, 500)))


def judged(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, quality (posterior)."""
    from .common import write_work
    names = list(rules())
    marks = measured(docs, id_col, text).withColumns(rules())
    # measured once; only the counts and votes are kept
    seen, _ = write_work(marks.select("doc_id", *FIELDS[:5], *names), "quality-measures")
    patterns = seen.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()   # at most 3 ** rules rows
    votes = np.array([[r[k] for k in names] for r in patterns], np.int64).reshape(-1, len(names))
    alarms = np.array([k in ALARMS for k in names])
    table = fit_em(votes, np.array([r.n for r in patterns], float), alarms)
    odds = np.log(table[1]) - np.log(table[0])
    x = F.lit(float(np.log(SHARE) - np.log1p(-SHARE)))
    for k, (bad, good) in zip(names, odds.tolist()):
        x = x + F.when(F.col(k) == BAD, bad).when(F.col(k) == GOOD, good).otherwise(0.0)
    return (seen.withColumn("base_failed", base_failed()).withColumn("quality", 1 / (1 + F.exp(-x)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep))
            .select("doc_id", *FIELDS[:5], "base_failed", "kept", "quality"))
