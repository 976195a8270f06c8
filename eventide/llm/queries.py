"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, icws, mixing, packing, prefixtrie, quality, rabitq, repeats, resample, secrets, tokenbin,
               toxicity, transducer)
from .common import table, text_col, write_work


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = icws.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", "class_id", "n_links", "n_group",
                       F.expr("doc_id <=> class_id and text_hash = winner_hash").alias("kept"))


def op2_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target text: the documents labelled as of high quality."""
    target = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return resample.resample(table(spark, sf_dir, "documents"), target)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn is a record {role, text}; conversation -7 holds the template's own control strings."""
    trap = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], rows.schema)
    record = F.to_json(F.struct("role", F.coalesce("text", F.lit("")).alias("text")), {"ignoreNullFields": "false"})
    # ties of the turn number: by role, then text
    order = F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    records = rows.unionByName(extra).select("conv_id", order.alias("turn"), record.alias("record"))
    return chat.digest(chat.read_back(chat.formatted(records, "conv_id", "turn", strict=True)))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal weight for every source; the texts go through the shuffle and are digested after it."""
    mixed = mixing.replicate(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("_mix_copies").cast("long").alias("copies"),
                        F.col("_mix_copy").cast("long").alias("copy"),
                        F.round("_mix_rate", 9).alias("rate"), F.col("_mix_order").alias("shuffle_key"),
                        F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokenbin.token_files(spark, table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "start", "n_tokens", tokenbin.crc32_of("ids").alias("ids_crc32"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = transducer.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the rebuilt conversations: c begins with the first crc32(c) % 4 turns of c - c % 20."""
    turns, _ = write_work(prefixtrie.turns_of(conversations), "trie-turns")
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % 4
    ids = turns.select("conv_id").distinct()
    base = turns.filter((c % 20 == 0) & (F.col("place") <= 3)).withColumnRenamed("conv_id", "base")
    heads = (ids.select("conv_id", (c - c % 20).alias("base"), h.alias("h")).join(base, "base")
             .filter("place <= h").select("conv_id", "place", "key", "words"))
    return heads.unionByName(turns.filter(F.col("place") > h)), ids


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(*rebuilt_turns(table(spark, sf_dir, "conversations")))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; every tenth document by crc32 goes on with its own words from a place on, periodically."""
    words = F.regexp_extract_all(text_col(), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = (docs.select("doc_id", text_col().alias("text"), h.alias("h"))
            .select("doc_id", "text", F.when(F.col("h") % 10 == 0, words).alias("w"),
                    F.floor(F.col("h") / 10).alias("g")))
    a = F.expr("int(g % size(w))")
    p = F.expr("int(1 + (size(w) - g % size(w)) div (3 + g % 8))")
    rows = rows.select("doc_id", "text", "w", F.when(F.size("w") > 0, a).alias("a"), F.when(F.size("w") > 0, p).alias("p"))
    again = F.expr("transform(w, (x, i) -> if(i < a, x, w[a + (i - a) % p]))")
    return rows.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text"))
                       .alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = repeats.greatest("runs")
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])                 # noqa: E731
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_resample": op2_resample,
    "op3_toxicity": op3_toxicity,
    "op4_pack": op4_pack,
    "op5_quality": op5_quality,
    "op6_near_vectors": op6_near_vectors,
    "op7_chat": op7_chat,
    "op8_mixing": op8_mixing,
    "op9_token_files": op9_token_files,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

# Pairs of equal labels by cosine, links counted, components by recursion over links.
_OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT vec_id, label, e FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e)
    AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

_UNIFORM = "(CAST(CAST(('0x' || substr(sha256({0}), 1, 13)) AS BIGINT) AS DOUBLE) + CAST(0.5 AS DOUBLE)) * pow(2.0, -52)"
# Poisson probabilities as exp(k ln m - m - ln k!), summed in the order of k.
_OP8 = f"""
WITH s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS total, count(*) AS k FROM s),
r AS (SELECT source, 1.0 / k * total / n AS m FROM s, t),
d AS (
  SELECT doc_id, d.source, text, m, {_UNIFORM.format("'9973|' || doc_id")} AS u
  FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
cdf AS (
  SELECT source, k, sum(exp(k * ln(m) - m - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
  FROM r, range(0, 200) x(k) WHERE k <= m + 12 * sqrt(m) + 30),
c AS (
  SELECT doc_id, d.source, text, m, count(*) FILTER (least(1.0, p) <= u) AS copies
  FROM d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source GROUP BY ALL)
SELECT doc_id, source, CAST(copies AS BIGINT) AS copies, CAST(copy AS BIGINT) AS copy, round(m, 9) AS rate,
  {_UNIFORM.format("'9974|' || doc_id || '|' || copy")} AS shuffle_key, md5(text) AS text_md5
FROM c, range(1, 201) y(copy) WHERE copy <= copies
"""

_OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(replace(replace(replace(replace(role, '\', '--'), '</turn>', '--/turn>'), '<turn>', '--turn>'), chr(10), '--'))
    + length(replace(replace(replace(text, '\', '--'), '</turn>', '--/turn>'), '<turn>', '--turn>'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# crc32 of the decimal id bit by bit; nodes are lists of turn digests.
_OP12 = r"""
WITH o AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, i, md5(length(r) || ':' || r || x) AS k, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM o),
ids AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)),
      lambda y, _: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT c FROM o)),
t AS (
  SELECT ids.c, i, k, w FROM ids JOIN k ON k.c = ids.c - ids.c % 20 AND i <= h
  UNION ALL SELECT ids.c, i, k, w FROM ids JOIN k ON k.c = ids.c AND i > h),
l AS (
  SELECT ids.c, coalesce(list(k ORDER BY i) FILTER (k IS NOT NULL), []) AS ks,
    coalesce(list(w ORDER BY i) FILTER (k IS NOT NULL), []) AS ws
  FROM ids LEFT JOIN t ON t.c = ids.c GROUP BY ids.c),
p AS (SELECT c, len(ks) AS n, d, ks[:d] AS key, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM l)),
nodes AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM p GROUP BY key, d),
children AS (SELECT key[:d - 1] AS key, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (key, d)),
tree AS (
  SELECT key[:j] AS key, j AS d, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM full_nodes) GROUP BY ALL)
SELECT a.conv_id, a.d AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM full_nodes a JOIN tree USING (key, d) LEFT JOIN nodes b ON a.d > 0 AND b.d = a.d - 1 AND b.key = a.key[:a.d - 1]
"""

ORACLE: dict[str, str] = {
    "op12_prefix_trie": _OP12,
    "op7_chat": _OP7,
    "op6_near_vectors": _OP6,
    "op8_mixing": _OP8,
}
