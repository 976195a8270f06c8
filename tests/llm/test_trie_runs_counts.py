import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import prefixtrie as P
from eventide.llm import queries as Q
from eventide.llm import repeats as R
from eventide.llm import transducer as T
from eventide.llm.tokens import default_tokenizer
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# token counts

def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


def library_counts(texts):
    return [len(e.ids) for e in library().encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machines():
    path = default_tokenizer()
    return [T.Counter(path), T.Counter(path, chunk=5, window=40, max_states=200)]


ALPHABET = "ab é'\n\t  .,1日\x1c\x85　stredmlvX=-<|>́\U000105c0\U0001f600"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=80), max_size=8))
def test_counts_are_the_librarys(machines, texts):
    for m in machines:
        assert m.counts(texts) == library_counts(texts)


def test_counts_of_long_words_and_special_strings(machines):
    texts = ["x" * 5000, "ab" * 3000, " " * 700, "=" * 1000 + "'s", "日本語" * 300, "a  <|endoftext|>  b<|endoftext|>",
             "I'll don't 're we'd'd''s !'s 'sx", "", "Zq" * 40 + "\n\n\n" + "9" * 500]
    for m in machines:
        assert m.counts(texts) == library_counts(texts)


def test_character_classes_are_the_librarys():
    pre, kinds = library().pre_tokenizer, T.char_classes()
    for c in range(0, 0x30000, 7):
        if 0xD800 <= c < 0xE000 or c == 32:
            continue
        own = T.library_class(pre, chr(c)) if kinds[c] == T.UNKNOWN else kinds[c]
        if own == T.SPACE:
            assert [s for s, _ in pre.pre_tokenize_str("." + chr(c))] != ["." + chr(c)]
        else:
            assert own == T.library_class(pre, chr(c))


def test_other_tokenizer_files_are_refused(tmp_path):
    import public_tokenizers
    with pytest.raises(ValueError):
        T.Counter(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts_of_a_table(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    want = sorted(zip([-1 if r.doc_id is None else r.doc_id for r in rows], [len((r.text or "").encode()) for r in rows],
                      library_counts([r.text or "" for r in rows])))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in T.token_counts(odd_docs).collect())
    assert got == want
    assert T.token_counts(no_docs).count() == 0


def test_op11_over_the_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in Q.op11_token_counts(spark, SF_SMALL).collect()}
    for (i, t), n in zip(docs.items(), library_counts(list(docs.values())), strict=True):
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len(t.encode()), n > 1024)


# prefix trie

def plain_trie(convs):
    """convs: id -> list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key, who in members.items():
        own = (len(who) - 1) * len(WORD.findall(key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] += own
            leaves[key[:d]] += not children[key]
    out = []
    for key, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(key))))
        out.append((min(who), len(key), min(members[key[:-1]]) if key else None, len(who), children[key], leaves[key],
                    saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def nodes_of(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: (r[1], r[0]))


TURNS = "conv_id long, turn long, role string, text string, key string, words long, n int, place int"


def conversation_rows(convs):
    return [(c, i, r, x, "k", 1, 2, 3) for c, turns in convs.items() for i, (r, x) in enumerate(turns)]


@pytest.mark.parametrize("width", [None, 64])
def test_trie_against_plain_python(spark, width):
    r = random.Random(11)
    convs = {}
    for c in range(300):
        convs[c] = [("user" if k % 2 == 0 else "assistant", " ".join(r.choice("ab") for _ in range(r.randint(0, 2))))
                    for k in range(r.randint(1, 6))]
    for c in range(300, 420):       # a group of copies, all of them with one first turn
        convs[c] = [("user", "same words here"), ("assistant", "yes")] + [("user", str(c % 3))] * (c % 4)
    rows = spark.createDataFrame(conversation_rows(convs), TURNS).repartition(5)
    empty = {5000: [], 5001: []}
    ids = rows.select("conv_id").union(spark.createDataFrame([(c,) for c in empty], "conv_id long"))
    got = nodes_of(P.prefix_trie(P.turns_of(rows), ids, width=width))
    assert got == plain_trie(convs | empty)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a b"), (2, None, "", ""), (2, 1, "user", "a b"), (2, 1, "user", "a b"),
            (None, 0, "user", "lost"), (3, 2, "b", "x"), (3, 2, "a", "y"), (3, 2, "a", "x" * 300_000), (4, 0, "1:", "z")]
    got = nodes_of(P.prefix_trie(P.turns_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    convs = {1: [("", ""), ("user", "a b")], 2: [("", ""), ("user", "a b"), ("user", "a b")],
             3: [("a", "x" * 300_000), ("a", "y"), ("b", "x")], 4: [("1:", "z")]}
    assert got == plain_trie(convs)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert P.prefix_trie(P.turns_of(none)).count() == 0


def test_long_end_lists(spark):
    """End lists over many segments and parts."""
    ids = spark.range(30_000).select((F.col("id") * 7).alias("conv_id"))
    turns = ids.select("conv_id", F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("hello you").alias("text"))
    got = nodes_of(P.prefix_trie(P.turns_of(turns)))
    text = ",".join(str(7 * k) for k in range(30_000))
    assert got[1] == (0, 1, 0, 30_000, 0, 1, 2 * 29_999, hashlib.sha256(text.encode()).hexdigest())
    assert got[0][3:7] == (30_000, 1, 1, 2 * 29_999)


def rebuilt(rows):
    """The contract's conversations in plain Python."""
    turns = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or "")):
        turns[r.conv_id].append((r.role or "", r.text or ""))
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def test_op12_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    assert nodes_of(Q.op12_prefix_trie(spark, SF_SMALL)) == plain_trie(rebuilt(rows))


def test_rebuilt_turns_without_a_base(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in [*range(0, 40, 3), *range(41, 60), 80, 81] for t in range(1 + c % 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert nodes_of(P.prefix_trie(*Q.rebuilt_turns(df))) == plain_trie(rebuilt(df.collect()))


# periodic runs

def plain_runs(w, min_words=24, exponent=3):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(min_words, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


@st.composite
def repetitive(draw):
    k, out = draw(st.sampled_from([1, 2, 3, 40])), []
    for _ in range(draw(st.integers(0, 6))):
        part = draw(st.lists(st.integers(0, k), min_size=1, max_size=9))
        times = draw(st.integers(1, 9))
        out += part * times + part[:draw(st.integers(0, 8))]
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(repetitive(), max_size=4), st.sampled_from([(24, 3), (6, 3), (4, 2), (9, 4)]))
def test_runs_are_those_of_brute_force(texts, limits):
    assert R.runs_of(texts, *limits) == [plain_runs(t, *limits) for t in texts]


def test_long_texts_of_one_word_and_of_long_periods():
    r = random.Random(2)
    part = [r.randrange(50) for _ in range(700)]
    assert R.runs_of([[1] * 30_000, part * 20, part * 2]) == [[(0, 30_000, 1)], [(0, 14_000, 700)], []]


def plain_row(doc_id, text, planted=True):
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if planted and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()     # noqa: E731
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


RUN_COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op13_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = sorted(tuple(r[c] for c in RUN_COLS) for r in Q.op13_periodic_runs(spark, SF_SMALL).collect())
    want = sorted(plain_row(r.doc_id, r.text) for r in rows)
    assert got == want and any(r[1] for r in want)


def test_periodic_runs_of_odd_documents(spark, odd_docs, no_docs, tmp_path):
    extra = [(500, " ".join(["la", "le"] * 20 + ["x"] + ["a b c d e f g h"] * 4)), (501, "z " * 24), (501, "z " * 24),
             (502, "z " * 23), (None, "y\n" * 90)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                 for r in R.periodic_runs(docs).collect())
    want = []
    for r in docs.collect():
        w = WORD.findall(r.text or "")
        runs = plain_runs(w) if len(w) < 5000 else []
        drop = {k for s, length, q in runs for k in range(s + q, s + length)}
        want.append((str(r.doc_id), len(w), runs, " ".join(x for k, x in enumerate(w) if k not in drop)))
    assert got == sorted(want)
    assert R.periodic_runs(no_docs).count() == 0
