"""Thin queries: each applies one operator to its whole table and returns its full result."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, decontam, exact_dedup, license_scan, line_dedup, near_dup, packing, quality, secrets, toxicity
from .common import read_table


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.verdicts(read_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark, sf_dir):
    r = line_dedup.verdicts(read_table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_lines", "n_dropped", F.array_join(F.transform("dropped", lambda x: x.cast("string")), ",").alias("dropped"))


def op3_quality(spark, sf_dir):
    return quality.score(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op5_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return decontam.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def tool_messages(turns):
    """Every turn as a message with tool traffic, as the table has none of its own.

    An assistant's turn calls a tool by the length of its text (well, with a wrong type, or an unknown one).
    Another turn but the first answers the turn before it, the turn after it or no call.
    """
    n, turn = F.length("text"), F.col("turn")
    at = lambda c: F.concat(F.lit("c"), c.cast("string"))
    known = F.struct(F.col("text").alias("query"), n.alias("limit"))
    wrong = F.struct(F.col("text").alias("url"), F.lit("soon").alias("timeout"))
    arguments = F.when(n % 3 == 0, F.to_json(known)).when(n % 3 == 1, F.to_json(wrong)).otherwise(F.lit("{}"))
    name = F.when(n % 3 == 0, "search").when(n % 3 == 1, "fetch").otherwise("unknown")
    call = F.struct(at(turn).alias("id"), F.struct(name.alias("name"), arguments.alias("arguments")).alias("function"))
    answers = F.when(n % 7 == 0, F.concat(F.lit("x"), turn.cast("string"))).when(n % 5 == 0, at(turn + 1)).otherwise(at(turn - 1))
    says = F.when(F.col("role") == "assistant", F.to_json(F.struct(F.array(call).alias("tool_calls"), F.col("text").alias("content"))))
    says = says.when(turn > 0, F.to_json(F.struct(answers.alias("tool_call_id"), F.col("text").alias("content")))).otherwise(F.col("text"))
    role = F.when((F.col("role") != "assistant") & (turn > 0), "tool").otherwise(F.col("role"))
    return turns.select("conv_id", "turn", role.alias("role"), says.alias("text"))


def op7_chat_format(spark, sf_dir):
    return chat.format_messages(tool_messages(read_table(spark, sf_dir, "conversations")))


def op8_toxicity(spark, sf_dir):
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_near_dedup(spark, sf_dir):
    return near_dup.components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op10_license_scan(spark, sf_dir):
    return license_scan.scan(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_line_dedup, op3_quality, op4_secret_scan, op5_packing, op6_decontamination, op7_chat_format, op8_toxicity, op9_near_dedup, op10_license_scan)}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents),
        g AS (SELECT n, count(*) AS group_size, max(length(t)) AS longest FROM d GROUP BY n),
        k AS (SELECT d.n, min(d.doc_id) AS keep_id FROM d JOIN g ON d.n = g.n AND length(d.t) = g.longest GROUP BY d.n)
        SELECT d.doc_id, k.keep_id, g.group_size, d.doc_id = k.keep_id AS kept, sha256(d.n) AS text_sha256
        FROM d JOIN g ON d.n = g.n JOIN k ON d.n = k.n""",
    "op2_line_dedup": r"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        x AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM d),
        o AS (SELECT doc_id, line_no, trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')) AS l, doc_id * 2147483648::HUGEINT + line_no AS pos FROM x),
        u AS (SELECT l, min(pos) AS pos, string_split(l, ' ') AS w, CASE WHEN len(string_split(l, ' ')) >= 8 THEN 0 WHEN length(l) >= 24 THEN 1 END AS kind FROM o WHERE l <> '' GROUP BY l),
        v AS (SELECT pos, kind, i, array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v FROM (SELECT pos, kind, w, unnest(range(1, len(w) + 1)) AS i FROM u WHERE kind = 0)
              UNION ALL SELECT pos, kind, i, substr(l, 1, i - 1) || substr(l, i + 1) FROM (SELECT pos, kind, l, unnest(range(1, length(l) + 1)) AS i FROM u WHERE kind = 1)),
        low AS (SELECT kind, i, v, min(pos) AS pos FROM v GROUP BY kind, i, v),
        near AS (SELECT v.pos FROM v JOIN low ON v.kind = low.kind AND v.i = low.i AND v.v = low.v WHERE low.pos < v.pos
                 UNION SELECT u.pos FROM u JOIN low ON u.kind = low.kind AND u.l = low.v WHERE low.pos < u.pos
                 UNION SELECT v.pos FROM v JOIN u ON v.kind = u.kind AND v.v = u.l WHERE u.pos < v.pos),
        gone AS (SELECT o.doc_id, o.line_no FROM o JOIN u ON o.l = u.l LEFT JOIN near ON u.pos = near.pos WHERE o.pos > u.pos OR near.pos IS NOT NULL),
        per AS (SELECT doc_id, count(*) AS n, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS x FROM gone GROUP BY doc_id)
        SELECT d.doc_id, len(d.ls)::BIGINT AS n_lines, coalesce(per.n, 0)::BIGINT AS n_dropped, coalesce(per.x, '') AS dropped
        FROM d LEFT JOIN per ON d.doc_id = per.doc_id""",
    "op7_chat_format": """
        WITH t AS (SELECT *, length(text) AS n, to_json(text)::VARCHAR AS j, role = 'assistant' AS calls, role <> 'assistant' AND turn > 0 AS answers FROM conversations),
        c AS (SELECT conv_id, turn, 'c' || turn AS id FROM t WHERE calls),
        r AS (SELECT conv_id, turn, CASE WHEN n % 7 = 0 THEN 'x' || turn WHEN n % 5 = 0 THEN 'c' || (turn + 1) ELSE 'c' || (turn - 1) END AS id FROM t WHERE answers),
        a AS (SELECT DISTINCT c.conv_id, c.turn FROM c JOIN r ON c.conv_id = r.conv_id AND c.id = r.id),
        l AS (SELECT r.conv_id, r.turn, r.id, c.turn AS call_turn FROM r LEFT JOIN c ON c.conv_id = r.conv_id AND c.id = r.id)
        SELECT t.conv_id, t.turn, CASE WHEN t.answers THEN 'tool' ELSE t.role END AS role, greatest(t.turn, coalesce(l.call_turn, t.turn)) AS at_turn, (coalesce(l.call_turn, t.turn) > t.turn)::INT AS at_rank,
               t.calls::BIGINT AS n_calls, (t.calls AND t.n % 3 = 0)::BIGINT AS n_valid, (t.calls AND a.turn IS NOT NULL)::BIGINT AS n_answered,
               CASE WHEN t.calls THEN CASE WHEN a.turn IS NULL THEN 'unanswered' ELSE 'answered' END WHEN t.answers THEN CASE WHEN l.call_turn IS NULL THEN 'orphan' ELSE 'linked' END ELSE 'plain' END AS status,
               '{"content":' || t.j || CASE
                 WHEN t.calls THEN ',"role":"assistant","tool_calls":[{"arguments":' || CASE t.n % 3 WHEN 0 THEN '{"limit":' || t.n || ',"query":' || t.j || '}' WHEN 1 THEN '{"timeout":"soon","url":' || t.j || '}' ELSE '{}' END
                   || ',"id":"c' || t.turn || '","name":"' || CASE t.n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'fetch' ELSE 'unknown' END || '","valid":' || (t.n % 3 = 0)::VARCHAR || '}]}'
                 WHEN t.answers THEN ',"role":"tool","tool_call_id":"' || l.id || '"}'
                 ELSE ',"role":' || to_json(t.role)::VARCHAR || '}' END AS message
        FROM t LEFT JOIN a ON t.conv_id = a.conv_id AND t.turn = a.turn LEFT JOIN l ON t.conv_id = l.conv_id AND t.turn = l.turn""",
}
