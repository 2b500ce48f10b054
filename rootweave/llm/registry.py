"""One query per operator, bound to the given tables, and the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootweave.llm import bpe, embeddings, jaccard, licences, linedup, mixing, resampling, rules, secrets, shards, topk, toxicity, whitening
from rootweave.llm.common import table
from rootweave.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op2_bpe(spark, sf_dir):
    import public_tokenizers as tokenizers

    ranks = tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, tokenizers.PATTERN).select("doc_id", "ids", "n_tokens")
    return bpe.decode(encoded, ranks).select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_quality(spark, sf_dir):
    rows = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rules.passes(rules.BASE)).alias("base_failed"),
        rules.passes(rules.PROSE_2).alias("kept"),
        "failed_bits",
    )


ORACLES["op3_quality"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
l AS (
  SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT doc_id, i, w[i] || chr(9) || w[i + 1] || chr(9) || w[i + 2] AS g FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w.w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w.w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words
  FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)
),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (word_chars < 2 * n_words)::BIGINT + 8 * (word_chars > 15 * n_words)::BIGINT
    + 16 * (2 * n_symbols > n_words)::BIGINT + 32 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
    + 64 * (100 * n_letter_words < 50 * n_words)::BIGINT AS failed_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""


@query
def op10_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shorter = linedup.drop_repeated_lines(docs, Workspace(spark), removed_col="removed_lines")
    return shorter.select("doc_id", "removed_lines", F.md5(F.col("text").cast("binary")).alias("text_md5"))


ORACLES["op10_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL
),
e AS (
  SELECT *, coalesce(substr(md5(lag(md5(line)) OVER d || md5(line)), 1, 2) < '40', false) AS ends FROM l
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
),
c AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM e
),
p AS (SELECT doc_id, k, min(pos) AS start, count(*) AS size, string_agg(line, chr(10) ORDER BY pos) AS passage FROM c GROUP BY doc_id, k),
f AS (
  SELECT doc_id, k, passage, size >= 2 AND trim(translate(passage, chr(10) || chr(9) || chr(13), '   ')) <> ''
    AND row_number() OVER (PARTITION BY passage ORDER BY doc_id, start) > 1 AS gone, size, start FROM p
),
t AS (
  SELECT doc_id, sum(CASE WHEN gone THEN size ELSE 0 END)::BIGINT AS removed_lines,
    coalesce(string_agg(passage, chr(10) ORDER BY start) FILTER (WHERE NOT gone), '') AS text FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(removed_lines, 0)::BIGINT AS removed_lines, md5(t.text) AS text_md5 FROM documents d LEFT JOIN t USING (doc_id)
"""


@query
def op5_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(secrets.samples(docs)))
    return found.select(
        "doc_id", *(secrets.count_of("base_spans", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(secrets.written("base_spans"), 256).alias("base_sha256"),
        secrets.written("spans").alias("spans"),
    )


TOXIC_FROM = 0.3


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Workspace(spark) as ws:
        model = toxicity.train(docs, table(spark, sf_dir, "labels"), ws)
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.is_held_out("doc_id").alias("held_out"), F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= TOXIC_FROM).cast("int").alias("predicted"), F.size("toxicity.spans").alias("n_spans"),
    )


MAX_REPEATS = 2.0


@query
def op1_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    planned = mixing.plan(docs, Workspace(spark), max_repeats=MAX_REPEATS)
    return mixing.realise(docs.select("doc_id", "source"), planned)


def mix_sql(docs: str, columns: str) -> str:
    """SQL for the mix of relation ``docs``: its ``columns`` with epoch and order key."""
    return rf"""
    WITH RECURSIVE d AS (
      SELECT *, coalesce('=' || source, '-') AS s, md5('mix|' || doc_id) AS h,
        len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens
      FROM {docs}
    ),
    t AS (SELECT s, sum(tokens)::DOUBLE AS n FROM d GROUP BY s),
    b AS (
      SELECT 0 AS i, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
      UNION ALL
      SELECT i + 1, CASE WHEN ok THEN low ELSE (low + high) / 2 END, CASE WHEN ok THEN (low + high) / 2 ELSE high END FROM (
        SELECT b.*, pow((SELECT max(n) / min(n) FROM t WHERE n > 0), 1 - (low + high) / 2) <= {MAX_REPEATS} AS ok FROM b WHERE i < 50
      )
    ),
    a AS (SELECT high AS a FROM b WHERE i = 50),
    c AS (SELECT max(n / pow(n, a)) AS cover FROM t, a WHERE n > 0),
    k AS (
      SELECT s, n, CASE WHEN n > 0 THEN round(pow(n, a) * cover) ELSE 0 END AS take FROM t, a, c
    ),
    p AS (SELECT s, take, n, CASE WHEN n > 0 THEN floor(take / n) ELSE 1 END::BIGINT AS part FROM k),
    o AS (
      SELECT d.*, part, take - part * n AS rest, sum(tokens) OVER (PARTITION BY s ORDER BY
        md5('mix|' || s || '|' || part || '|' || h[1:3]), md5('mix|' || s || '|' || part || '|' || h[1:6]),
        md5('mix|' || s || '|' || part || '|doc' || doc_id)) AS until
      FROM d JOIN p USING (s)
    ),
    e AS (SELECT *, unnest(range(0, part + (rest > 0 AND until <= rest)::BIGINT)) AS epoch FROM o)
    SELECT {columns}, epoch::INT AS epoch, md5('mix|' || s || '|' || epoch || '|' || h[1:3]) AS order_key FROM e"""


ORACLES["op1_mixing"] = mix_sql("documents", "doc_id, source")


@query
def op7_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, Workspace(spark), size=3, percent=90)


@query
def op8_embedding_dedup(spark, sf_dir):
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), Workspace(spark))


@query
def op6_shards(spark, sf_dir):
    # Byte-level ids: one per UTF-8 byte.
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("ids"))
    ws = Workspace(spark)
    path = f"{ws.path}/shards"
    shards.write(docs, ws, path, width=1, length=2_048)
    return shards.read(spark, path, width=1).select(
        "slot", "shard", "offset", "doc_id", "piece", "n_ids", F.md5("ids").alias("ids_md5")
    )


@query
def op9_licences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs, licences.known_licences(spark)).select(
        "doc_id", F.array_join("licences", ",").alias("licences"), "whole_text"
    )


def _licence_sql() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    known = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in licences.KNOWN)
    words = r"""' ' || trim(regexp_replace(regexp_replace(lower(text), {line}, ' ', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '""".format(
        line=quote(licences.COPYRIGHT_LINE)
    )
    for spelling, standard in licences.SPELLINGS:
        words = f"replace({words}, ' {spelling} ', ' {standard} ')"
    return rf"""
    WITH k AS (SELECT DISTINCT licence, {words} AS form FROM (VALUES {known}) AS t(licence, text)),
    u AS (
      SELECT doc_id, coalesce(text, '') AS text, true AS whole FROM documents
      UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))), false FROM documents WHERE contains(text, chr(10))
      UNION ALL SELECT doc_id, unnest(string_split_regex(text, '\n{{2,}}')), false FROM documents WHERE contains(text, chr(10) || chr(10))
    ),
    f AS (SELECT doc_id, whole, {words} AS form FROM u)
    SELECT doc_id, coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences,
      bool_or(whole AND licence IS NOT NULL) AS whole_text
    FROM f LEFT JOIN k USING (form) GROUP BY doc_id"""


ORACLES["op9_licences"] = _licence_sql()


@query
def op11_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"), Workspace(spark))


# The checksum of a word, byte by byte; no engine function has it.
ORACLES["op11_resampling"] = r"""
WITH RECURSIVE step AS (
  SELECT i, i AS v, 0 AS k FROM (SELECT unnest(range(0, 256)) AS i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS m FROM step WHERE k = 8),
texts AS (
  SELECT doc_id, true AS own, coalesce(text, '') AS t FROM documents
  UNION ALL SELECT NULL, false, coalesce(text, '') FROM benchmark
),
lowered AS (SELECT doc_id, own, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM texts),
words AS (SELECT doc_id, own, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM lowered),
each AS (SELECT doc_id, own, unnest(ws) AS w FROM words),
counted AS (SELECT doc_id, own, w, count(*) AS n FROM each GROUP BY ALL),
hashed AS (
  SELECT w, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, m[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM counted), crc
),
features AS (SELECT doc_id, own, bucket, n FROM counted JOIN hashed USING (w)),
shares AS (
  SELECT bucket, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t FROM features GROUP BY bucket
),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM shares),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM shares, totals),
weights AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM features JOIN gain USING (bucket) WHERE own GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
),
ranked AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place,
    10 * count(*) FILTER (n_features >= 20) OVER () // 100 AS k FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank FROM ranked
"""


@query
def op13_top_k(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), Workspace(spark), F.col("_id") % 100 == 0)


ORACLES["op13_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * v.x[i]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id AND len(q.x) = len(v.x)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), Workspace(spark)).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
