"""The registered queries of the operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.llm import (centroids, decontaminate, exact_dedup, jaccard_join, labelled, langid, matrix_join, packing,
                           periodic_runs, pii, quality, tool_calls, toxicity, warc)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(_documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def _classified(module, label: str, folds: int, fold: int, spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = module.train(docs, labels, ~labelled.held_out("id", folds, fold), label)
    scored = module.score(docs, model)
    return scored.select("doc_id", labelled.held_out("doc_id", folds, fold).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(toxicity, "toxic", 4, 2, spark, folder)


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(spark.read.parquet(f"{folder}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


#: the tools the derived calls may use: name, parameter, kind, required
TOOLS = [("measure", "unit", "string", True), ("measure", "value", "integer", True), ("search", "query", "string", True),
         ("search", "top_k", "integer", False), ("translate", "text", "string", True), ("translate", "to", "string", True)]


def op4_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Every assistant turn read as a call of a tool on its text, every later user turn as the result of the turn before.

    The tool and the faults in its arguments follow from the text's length and the turn.  A call needs the one two turns
    earlier, so chains are as long as conversations.
    """
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    listed = F.to_json(F.array(F.coalesce("text", F.lit(""))))
    turns = turns.withColumn("n", F.coalesce(F.length("text"), F.lit(0))).withColumn(
        "q", listed.substr(F.lit(2), F.length(listed) - 2))
    called = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.expr("concat('call_', conv_id, '_', turn)").alias("call_id"),
        F.expr("element_at(array('search', 'translate', 'measure', 'browse'), n % 4 + 1)").alias("name"),
        F.expr("""CASE n % 4 WHEN 0 THEN concat('{"top_k": ', n % 7, ', "query": ', q, '}')
                  WHEN 1 THEN concat('{', if(n % 5 = 0, '', '"to": "en", '), '"text": ', q, '}')
                  WHEN 2 THEN concat('{ "value": ', if(turn % 3 = 0, concat('"', n, '"'), string(n)), ', "unit": "sign"',
                                     if(n % 11 = 0, ', "note": true', ''), '}')
                  ELSE concat('[', q, ']') END""").alias("arguments"),
        F.expr("if(turn >= 2, array(concat('call_', conv_id, '_', turn - 2)), cast(array() as array<string>))")
        .alias("needs"))
    answered = turns.where("role = 'user' and turn > 0").select(
        "conv_id", "turn", F.expr("concat('call_', conv_id, '_', turn - 1)").alias("call_id"), F.col("text").alias("content"))
    schemas = spark.createDataFrame(TOOLS, "name string, param string, kind string, required boolean")
    found = tool_calls.link(called, answered, schemas)
    return found.select("conv_id", "turn", "call_id", "name", "step", "status",
                        F.array_join("problems", "; ").alias("problems"), "json")


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_documents(spark, folder))
    counts = [F.expr(f"cast(size(filter(found, s -> s.base and s.kind = '{k}')) as long)").alias(f"n_{k}")
              for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    held = labelled.held_out("doc_id", 5, 0)
    found = langid.identify(docs, langid.train(docs, ~labelled.held_out("id", 5, 0)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, folder), keep="max")


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.jaccard_components(_documents(spark, folder), words=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(quality, "quality", 5, 0, spark, folder)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, folder), tokenizer_path(), capacity=1024, end_id=2)


#: the text with its words from a on repeated with period p, for a tenth of the ids (h % 10 = 0).  One-element arrays keep
#: what is used in a lambda from being worked out anew for every word
_REPEATED = r"""
if(pmod(crc32(cast(cast(doc_id as string) as binary)), 10) = 0 and text rlike '[^\\x20\\x09-\\x0D]',
   transform(array(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)), w ->
     transform(array(named_struct('n', cast(size(w) as long), 'g', crc32(cast(cast(doc_id as string) as binary)) div 10)), s ->
       transform(array(named_struct('a', s.g % s.n, 'p', 1 + (s.n - s.g % s.n) div (3 + s.g % 8))), t ->
         array_join(transform(w, (x, i) -> if(i < t.a, x, w[cast(t.a + (i - t.a) % t.p as int)])), ' '))[0])[0])[0],
   text)"""


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", F.expr(_REPEATED).alias("text"))
    found = periodic_runs.find(docs, least=24, times=3)
    first = F.expr("aggregate(runs, runs[0], (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    best = found.select("*", F.when(F.size("runs") > 0, first).alias("best"))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"), k=8, rounds=10, scale=1024, salt="3:")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def op13_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return matrix_join.nearest(rows, F.col("vec_id") % 20 == 0, k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_warc": op3_warc,
    "op4_tool_calls": op4_tool_calls,
    "op5_pii": op5_pii,
    "op6_language": op6_language,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_quality": op9_quality,
    "op10_packing": op10_packing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_centroid_clusters": op12_centroid_clusters,
    "op13_nearest": op13_nearest,
}

# ---- SQL -------------------------------------------------------------------------------------------------------------
SQL: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op8_jaccard_join"] = rf"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])
                                      WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM listed),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * k >= 90 * (s.n + t.n - k)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

SQL["op11_periodic_runs"] = r"""
WITH ids AS (SELECT doc_id, coalesce(text, '') AS text, doc_id::VARCHAR AS d FROM documents),
crc AS (SELECT doc_id, text, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, len(d) + 1),
               lambda i: list_concat([ord(d[i])], list_transform(range(8), lambda k: -1))))),
               lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS h
        FROM ids),
listed AS (SELECT doc_id, coalesce(h, 1) AS h, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM crc),
cut AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM listed),
docs AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1:a], list_transform(range(a, n),
           lambda i: w[1 + a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8))])) END AS w FROM cut),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i + 1:i + 8], ' ')) AS g
         FROM (SELECT doc_id, w, unnest(range(n - 7)) AS i FROM docs WHERE n >= 24)),
-- windows that stand q words apart, in stretches without a gap
same AS (SELECT y.doc_id, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY y.doc_id, y.i - x.i ORDER BY x.i) AS part
         FROM wins x JOIN wins y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
found AS (SELECT doc_id, min(i) AS start, count(*) + 7 + q AS length, q AS period FROM same GROUP BY doc_id, q, part
          HAVING count(*) + 7 + q >= greatest(24, 3 * q)),
runs AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY doc_id, start, length ORDER BY period) = 1),
best AS (SELECT * FROM runs
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
listing AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
                                                         ORDER BY start, period) AS t FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS x, unnest(range(n)) AS i FROM docs) p
         WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = p.doc_id AND p.i >= r.start + r.period AND p.i < r.start + r.length)
         GROUP BY doc_id)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
       b.period::BIGINT AS period, (1000 * b.length // b.period)::BIGINT AS exponent_milli,
       sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listing l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

SQL["op1_decontaminate"] = rf"""
WITH listed AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: w[i:i + least(len(w), 10) - 1])) AS g
  FROM items WHERE len(w) > 0),
wins AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM listed, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n),
hits AS (
  SELECT DISTINCT x.doc_id, x.i, x.n, g.item_id FROM (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM wins) x
  JOIN grams g ON g.g = x.g AND g.n = x.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT l.doc_id, len(l.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM listed l LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

SQL["op7_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size, doc_id = max(doc_id) OVER t AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
"""

SQL["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
hashed AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
         (('0x' || substr(x, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""

SQL["op4_tool_calls"] = r"""
WITH RECURSIVE turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text, coalesce(length(text), 0) AS n,
                                to_json(coalesce(text, ''))::VARCHAR AS q FROM conversations),
calls AS (
  SELECT conv_id, turn, n, 'call_' || conv_id || '_' || turn AS call_id,
         ['search', 'translate', 'measure', 'browse'][n % 4 + 1] AS name,
         CASE n % 4 WHEN 0 THEN '{"query":' || q || ',"top_k":' || (n % 7) || '}'
              WHEN 1 THEN '{"text":' || q || CASE WHEN n % 5 = 0 THEN '' ELSE ',"to":"en"' END || '}'
              WHEN 2 THEN '{' || CASE WHEN n % 11 = 0 THEN '"note":true,' ELSE '' END || '"unit":"sign","value":' ||
                          CASE WHEN turn % 3 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END || '}'
              ELSE '[' || q || ']' END AS arguments,
         CASE n % 4 WHEN 0 THEN '' WHEN 1 THEN CASE WHEN n % 5 = 0 THEN 'missing to' ELSE '' END
              WHEN 2 THEN concat_ws('; ', CASE WHEN turn % 3 = 0 THEN 'type of value' END,
                                    CASE WHEN n % 11 = 0 THEN 'unknown note' END)
              ELSE 'unknown tool' END AS problems,
         CASE WHEN turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2) END AS need
  FROM turns WHERE role = 'assistant'),
answers AS (SELECT conv_id, turn, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text, q FROM turns
            WHERE role = 'user' AND turn > 0),
steps(conv_id, call_id, step) AS (
  SELECT conv_id, call_id, 0 FROM calls c WHERE NOT EXISTS (SELECT 1 FROM calls d WHERE d.call_id = c.need)
  UNION ALL SELECT c.conv_id, c.call_id, s.step + 1 FROM steps s JOIN calls c ON c.need = s.call_id),
linked AS (
  SELECT c.conv_id, c.turn, c.call_id, c.name, s.step, c.problems, c.arguments, a.q,
         CASE WHEN c.problems <> '' THEN 'invalid' WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'ok' END AS status
  FROM calls c JOIN steps s USING (call_id) LEFT JOIN answers a USING (call_id))
SELECT conv_id, turn, call_id, name, step, status, problems,
       '{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || name || '"' ||
       CASE WHEN q IS NULL THEN '' ELSE ',"result":' || q END || ',"status":"' || status || '","step":' || step || '}' AS json
FROM linked
UNION ALL
SELECT conv_id, turn, call_id, NULL, NULL, 'orphan', '',
       '{"id":"' || call_id || '","result":' || q || ',"status":"orphan"}'
FROM answers WHERE call_id NOT IN (SELECT call_id FROM calls)
"""

SQL["op13_nearest"] = """
WITH sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
met AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
        FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER t)::INT AS rank, vec_id, score FROM met
WINDOW t AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20
"""


def _lloyd(rounds: int, k: int, width: int, scale: int, salt: str) -> str:
    """Each round as two tables: every vector with its cluster, and the centroids that follow from it."""
    far = "list_sum(list_transform(range(1, {w} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))".format(w=width)
    assigned = f"""SELECT vec_id, v, n, far::BIGINT AS distance FROM (SELECT vec_id, v, n, {far} AS far FROM kept, c{{r}})
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY far, n) = 1"""
    parts = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{salt}' || vec_id)) - 1)::INT AS n, v AS c FROM kept
      QUALIFY n < {k})"""]
    for r in range(rounds):
        parts += [f"a{r} AS MATERIALIZED ({assigned.format(r=r)})", f"""m{r} AS (
      SELECT n, list((s - ((s % k) + k) % k) // k ORDER BY i) AS c FROM (
        SELECT n, i, sum(x)::BIGINT AS s, count(*) AS k FROM (SELECT n, unnest(v) AS x, unnest(range({width})) AS i FROM a{r})
        GROUP BY n, i) GROUP BY n)""",
                  f"""c{r + 1} AS MATERIALIZED (SELECT o.n, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (n))"""]
    parts.append(f"last AS MATERIALIZED ({assigned.format(r=rounds)})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, n AS cluster, distance, (sum(distance) OVER (PARTITION BY n))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{rounds} USING (n)"""


SQL["op12_centroid_clusters"] = _lloyd(10, 8, 64, 1024, "3:")
