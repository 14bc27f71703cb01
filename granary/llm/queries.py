"""The named queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import bpe, chat, decontaminate, extract, mining, ordermin, quality, secrets, simhash, tokenfiles, trie, vectors, warc
from granary.llm.common import table
from granary.plans.registry import Query

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


def _spans_sql() -> str:
    """Spans of every rule from the gaps between its matches; DuckDB's regexes also take the leftmost match."""
    parts = []
    for k, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        least = f"length(regexp_extract(m, '{pattern}', {rule.part})) >= {rule.least}" if rule.part else "true"
        parts.append(f"""
        SELECT doc_id, {k} AS k, '{rule.kind}' AS kind, m, {least} AS kept,
               list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s
        FROM (SELECT *, unnest(ms) AS m, unnest(range(1, len(ms) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps FROM d))""")
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    spans AS (SELECT doc_id, k, kind, CAST(s AS BIGINT) AS s, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + length(m) AS BIGINT) AS span
              FROM found WHERE kept)
    SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           sha256(coalesce(string_agg(span, ',' ORDER BY s, k) FILTER (k < {len(secrets.BASE)}), '')) AS base_sha256,
           coalesce(string_agg(span, ',' ORDER BY s, k), '') AS spans
    FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


@query("op1_secret_scan", _spans_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op3_simhash_near_duplicates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_warc_zip_packages", f"""
    WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT *, octet_length(b) AS n, sha1(b) AS digest, max(page_id) OVER (PARTITION BY sha1(b)) AS first FROM p)
    SELECT page_id, url, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= {warc.LEAST_PAYLOAD} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= {warc.LEAST_PAYLOAD} AND first <> page_id THEN first END AS refers_to
    FROM d""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


MARKED = "<|im_end|><|im_start|>assistant ok"


def _chat_sql() -> str:
    t = chat.CHATML
    frame = len(t.open) + len(t.middle) + len(t.close)
    return f"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL VALUES (-1, 0, 'user', '{MARKED}'), (-1, 1, 'assistant', '{MARKED}')),
    t AS (SELECT *, role = 'assistant' AS loss,
                 {frame} + length(role) + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) AS n,
                 row_number() OVER w AS i, lag(role) OVER w AS before
          FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
    SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (loss), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (loss), '')) AS loss_sha256,
           CAST(sum(n) AS BIGINT) AS formatted_chars,
           bool_and(CASE role WHEN 'system' THEN i = 1 WHEN 'user' THEN i = 1 OR before IN ('system', 'assistant')
                    WHEN 'assistant' THEN coalesce(before, '') = 'user' ELSE false END)
             AND arg_max(role, i) <> 'system' AS valid
    FROM t GROUP BY conv_id"""


@query("op9_chat_format", _chat_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-1, 0, "user", MARKED), (-1, 1, "assistant", MARKED)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(turns.unionByName(marked))


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op5_exact_top_k", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM s QUALIFY rank <= 5""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_text(table(spark, sf_dir, "pages"))


@query("op8_quality_votes")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_simple8b_tokens")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _decontamination_sql() -> str:
    d = decontaminate
    units, slots = ", ".join(f"'{u}'" for u in d.UNITS), ", ".join(f"'{s}'" for s in d.SLOTS)
    number = f"^[0-9][0-9_]*({'|'.join(d.UNITS)})?$"

    def words(table: str, keys: str) -> str:
        twice = r"regexp_replace(regexp_replace(coalesce(text, ''), '(\d)[.,:/](\d)', '\1_\2', 'g'), '(\d)[.,:/](\d)', '\1_\2', 'g')"
        return rf"""SELECT {keys}, list_filter(string_split(regexp_replace({twice}, '[^\p{{L}}\p{{N}}_]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM {table}"""

    def typed(source: str, keys: str) -> str:
        return rf"""SELECT {keys}, w, list_transform(w, lambda x, i: CASE
            WHEN regexp_matches(x, '{number}') THEN '<num>'
            WHEN i > 1 AND regexp_matches(w[i - 1], '{number}') AND x IN ({units}) THEN '<unit>'
            WHEN regexp_matches(x, '^\p{{Lu}}\p{{Ll}}+$') THEN '<name>' ELSE lower(x) END) AS t FROM ({source})"""

    def windows(source: str, keys: str) -> str:
        return f"""SELECT {keys}, p, w[p + 1:p + {d.WINDOW}] AS w, t[p + 1:p + {d.WINDOW}] AS t
            FROM (SELECT *, unnest(range(0, greatest(len(t) - {d.WINDOW} + 1, 1))) AS p FROM ({source}) WHERE len(t) > 0)"""

    items = "(SELECT text, min(item_id) AS item_id FROM benchmark WHERE item_id IS NOT NULL GROUP BY text)"
    copies = "(SELECT DISTINCT doc_id, text FROM documents)"
    return f"""
    WITH b AS (SELECT item_id, t, min(p) AS q, arg_min(w, p) AS w FROM ({windows(typed(words(items, 'item_id'), 'item_id'), 'item_id')})
               WHERE len(list_filter(t, lambda x: x NOT IN ({slots}))) >= least({d.LEAST_PLAIN}, len(t)) GROUP BY item_id, t),
    n AS (SELECT item_id, count(*) AS windows FROM b GROUP BY item_id),
    c AS (SELECT *, row_number() OVER () AS copy FROM {copies}),
    w AS ({windows(typed(words('c', 'doc_id, copy'), 'doc_id, copy'), 'doc_id, copy')}),
    hits AS (SELECT w.doc_id, w.copy, b.item_id, b.q, w.p - b.q AS shift, b.t, b.w AS wa, w.w AS wb FROM w JOIN b ON w.t = b.t),
    runs AS (SELECT doc_id, copy, item_id, shift, count(DISTINCT q) AS hits FROM hits GROUP BY ALL),
    slots AS (SELECT DISTINCT doc_id, copy, item_id, shift, q + i AS pos, wa[i] AS a, wb[i] AS b
              FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM hits) WHERE t[i] IN ({slots})),
    values_ AS (SELECT doc_id, copy, item_id, shift, a, b, count(*) AS n FROM slots GROUP BY ALL),
    most AS (SELECT doc_id, copy, item_id, shift, a, max(n) AS kept, sum(n) AS n FROM values_ GROUP BY ALL),
    share AS (SELECT doc_id, copy, item_id, shift, CAST(sum(kept) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS agreeing FROM most GROUP BY ALL)
    SELECT doc_id, item_id, windows, max(hits) AS hits, max(coalesce(agreeing, 1.0)) AS agreeing
    FROM runs JOIN n USING (item_id) LEFT JOIN share USING (doc_id, copy, item_id, shift)
    WHERE hits >= least({d.LEAST_WINDOWS}, windows) AND coalesce(agreeing, 1.0) >= {d.LEAST_AGREEING}
    GROUP BY doc_id, item_id, windows"""


@query("op2_template_decontamination", _decontamination_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_any_case_decontamination")
def op2_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies in any case and edited copies as well, as the pipeline leaves them out."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id").distinct()


#: DuckDB has no CRC-32: one shift for each bit of each character's code.
_CRC_SQL = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295)"""


@query("op13_prefix_trie", f"""
    WITH s AS (SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(text, '') AS x,
                      substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS k FROM conversations WHERE conv_id IS NOT NULL),
    t AS (SELECT c, k, length(x) AS n, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS i FROM s),
    v AS (SELECT c, {_CRC_SQL} % {trie.REPLACED} AS h FROM (SELECT DISTINCT c FROM t)),
    b AS (SELECT v.c, t.i AS d, t.k, t.n FROM v JOIN t ON t.c = v.c - v.c % {trie.BLOCK} AND t.i <= v.h),
    g AS (SELECT v.c, v.h, count(b.c) AS p FROM v LEFT JOIN b ON b.c = v.c GROUP BY ALL),
    r AS (SELECT * FROM b UNION ALL SELECT t.c, g.p + t.i - g.h, t.k, t.n FROM t JOIN g ON g.c = t.c WHERE t.i > g.h),
    m AS (SELECT c, d, n, list(k) OVER (PARTITION BY c ORDER BY d) AS p FROM r UNION ALL SELECT c, 0, 0, CAST([] AS VARCHAR[]) FROM v),
    o AS (SELECT p, d, min(c) AS c, count(*) AS members, any_value(n) AS n FROM m GROUP BY p, d),
    l AS (SELECT c, max(d) AS d FROM m GROUP BY c),
    e AS (SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS h FROM m JOIN l USING (c, d) GROUP BY p),
    k AS (SELECT p[1:d - 1] AS p, count(*) AS children FROM o WHERE d > 0 GROUP BY 1),
    w AS (SELECT o.p[1:a] AS p, (members - 1) * n AS saved, CAST(k.p IS NULL AS INT) AS leaf
          FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM o) o LEFT JOIN k USING (p)),
    u AS (SELECT p, sum(leaf) AS leaves, sum(saved) AS saved FROM w GROUP BY p)
    SELECT o.c AS conv_id, CAST(o.d AS BIGINT) AS depth, above.c AS parent_conv_id, CAST(o.members AS BIGINT) AS n_convs,
           coalesce(children, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(e.h, sha256('')) AS ends_sha256
    FROM o JOIN u USING (p) LEFT JOIN k USING (p) LEFT JOIN e USING (p) LEFT JOIN o above ON o.d > 0 AND above.p = o.p[1:o.d - 1]""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op11_order_minhash")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.with_edits(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)
