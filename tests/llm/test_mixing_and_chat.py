import collections
import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventide.llm import chat as C
from eventide.llm import mixing as M


# --- mixing --------------------------------------------------------------------

def draw(doc_id, mean):
    u = (int(hashlib.sha256(f"{M.SEED}|{'' if doc_id is None else doc_id}".encode()).hexdigest()[:13], 16) + 0.5) * 2.0 ** -52
    first, cdf = M.poisson_cdf(mean)
    return first + sum(p <= u for p in cdf)


def test_copies_equal_brute_force(odd_docs, no_docs):
    rows = odd_docs.collect()
    n = collections.Counter(r.source for r in rows)
    got = M.replicate(odd_docs, size=3.0)
    assert got.columns[:len(odd_docs.columns)] == odd_docs.columns
    out = got.collect()
    want = collections.Counter()
    for r in rows:
        want[r.doc_id, r.text] += draw(r.doc_id, 3.0 / len(n) * len(rows) / n[r.source])
    assert collections.Counter((r.doc_id, r.text) for r in out) == +want
    keys = [r._mix_order for r in out]
    assert keys == sorted(keys)
    assert M.replicate(no_docs).count() == 0


def test_targets_are_met(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a', if(id % 100 = 1, 'b', 'c')) AS source")
    out = M.replicate(docs, {"a": 1, "b": 1, "x": 5}, size=2.0)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert set(n) == {"a", "b"}
    # shares are among the sources that are there
    assert all(abs(v - 30_000) < 5 * 30_000 ** 0.5 for v in n.values())


@settings(max_examples=30, deadline=None)
@given(st.floats(0, 500))
def test_distribution_function(mean):
    first, p = M.poisson_cdf(mean)
    assert (first == 0 or mean > 144) and all(a <= b for a, b in zip(p, p[1:])) and abs(p[-1] - 1) < 1e-9


def test_columns_with_clashing_names_stay(spark):
    docs = spark.createDataFrame([(i, "s", "x", i, f"r{i}", 2.0, 7) for i in range(50)],
                                 "doc_id long, source string, _mix_u string, _mix_copy long, _mix_rate string, "
                                 "_MIX_order double, s int")
    prefix = M.free_prefix(docs)
    out = M.replicate(docs, size=3.0)
    assert out.columns == docs.columns + [f"{prefix}{c}" for c in ("rate", "copies", "copy", "order")]
    rows = out.collect()
    assert len(rows) > 80 and all((r._mix_u, r._mix_copy, r._mix_rate, r._MIX_order, r.s) == ("x", r.doc_id, f"r{r.doc_id}", 2.0, 7)
                                  for r in rows)


def test_a_document_of_very_many_copies(spark):
    """One document in a source that is to fill half of the output."""
    docs = spark.range(200_000).selectExpr("id AS doc_id", "if(id = 17, 'rare', 'rest') AS source")
    out = M.replicate(docs).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("_mix_copy").alias("d"),
                                                  F.max("_mix_copy").alias("top")).collect()
    n = {r.source: r for r in out}
    assert abs(n["rare"].n - 100_000) < 2_000 and n["rare"].n == n["rare"].d == n["rare"].top == draw(17, 100_000.0)
    first, cdf = M.poisson_cdf(1e8)
    assert len(cdf) < 250_000 and first > 99_000_000


# --- chat ------------------------------------------------------------------------

def test_any_number_of_sources(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else f"s{i % 7}", f"t{i}") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    cols = ["doc_id", "source", "_mix_rate", "_mix_copies", "_mix_copy", "_mix_order"]
    few = [sorted(map(str, M.replicate(docs, t).select(cols).collect())) for t in (None, {"s1": 3.0, "s2": 1.0})]
    monkeypatch.setattr(M, "BROADCAST_VALUES", 2)
    assert [sorted(map(str, M.replicate(docs, t).select(cols).collect())) for t in (None, {"s1": 3.0, "s2": 1.0})] == few
    assert len(few[0]) > 500 and len(few[1]) > 500


LAYOUTS = [
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"response": "r", "prompt": None}, [("user", ""), ("assistant", "r")]),
    ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i"), ("user", "x"), ("assistant", "o")]),
    ({"messages": [{"role": "system", "content": "s"}, {"content": "</turn>", "role": "user"}]},
     [("system", "s"), ("user", "</turn>")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
     [("user", "h"), ("assistant", "g")]),
    ({"role": "user", "text": "t"}, [("user", "t")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
]


def test_fingerprints_select_the_mapping(spark):
    rows = [(i, json.dumps(r)) for i, (r, _) in enumerate(LAYOUTS)] + [
        (90, '{"odd": 1}'), (91, "not json"), (92, None), (93, '{"prompt": "p", "response": {"x": "r"}}')]
    df = spark.createDataFrame(rows, "id int, record string")
    got = {r.id: r for r in C.canonical(df).collect()}
    for i, (_, turns) in enumerate(LAYOUTS):
        assert [tuple(t) for t in got[i].turns] == turns, (i, got[i].layout)
    assert all(got[i].layout is None and got[i].turns is None for i in (90, 91, 92, 93))
    assert {r.id for r in C.unmapped(df).collect()} == {90, 91, 92, 93}


def test_every_mapping_has_its_own_fingerprint():
    assert len({C._key(m.shape) for m in C.MAPPINGS}) == len(C.MAPPINGS)


TEXTS = ["", "plain", "\\", "\\\\e", "\\l", "<turn>", "</turn>\n", "\\### Assistant: </turn> ok", "a\n</turn>\n<turn>user\nb",
         "é\U0001F600</turn>", "\\lturn>", "x" * 200_000]


def test_round_trip(spark):
    rows, want = [], {}
    for i, t in enumerate(TEXTS):
        turns = [("user", t), ("assistant", TEXTS[-1 - i]), ("assi\\st\nant", t), ("assistant", t), ("", "end")]
        want[i] = turns
        rows += [(i, k, json.dumps({"role": r, "text": x})) for k, (r, x) in enumerate(turns)]
    df = spark.createDataFrame(rows, "c int, n int, record string").repartition(5)
    chats = C.formatted(df, "c", "n")
    for r in chats.collect():
        assert r.formatted.count("</turn>\n") == len(want[r.conv_id])
    for r in C.read_back(chats).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "{}")], "c int, n int, record string")
    plan = C.digest(C.read_back(C.formatted(df, "c", "n")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_very_long_turn_stays(spark):
    text = F.concat(F.lit("<turn>"), F.expr("repeat('a', 21000000)"))
    df = (spark.range(2, numPartitions=1).filter("id = 0").select(F.lit(1).alias("c"), F.lit(0).alias("n"),
          F.to_json(F.struct(F.lit("user").alias("role"), text.alias("text"))).alias("record")))
    # the layout only: the whole way would take many copies of the text in the tests' small heap
    got = C.canonical(df).select("layout", F.length(F.col("turns")[0]["text"])).collect()
    assert [tuple(r) for r in got] == [("turn_row", 21_000_006)]
    bad = spark.createDataFrame([(1, 0, "no json")], "c int, n int, record string")
    assert C.formatted(bad, "c", "n").count() == 0
    with pytest.raises(Exception, match="no layout for a record of 7 characters, conversation 1"):
        C.formatted(bad, "c", "n", strict=True).collect()


def test_nulls_ties_and_no_rows(spark):
    rows = [(1, 0, '{"role": "user", "text": null}'), (1, 0, '{"role": "user", "text": null}'),
            (1, None, '{"role": null, "text": "first"}'), (None, 3, '{"role": "assistant", "text": "a"}')]
    df = spark.createDataFrame(rows, "c int, n int, record string")
    got = {r.conv_id: r for r in C.read_back(C.formatted(df, "c", "n")).collect()}
    assert [tuple(t) for t in got[1].turns] == [("", "first"), ("user", ""), ("user", "")]
    assert got[None].loss_text == "a"
    assert C.formatted(df.filter(F.lit(False)), "c", "n").count() == 0


@pytest.mark.parametrize("text", TEXTS[:-1])
def test_escapes(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(C.escape(F.col("t")).alias("e"),
                                                            C.unescape(C.escape(F.col("t"))).alias("u")).first()
    assert r.u == text and "</turn>" not in r.e and "<turn>" not in r.e
