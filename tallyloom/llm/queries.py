"""The registered queries of this package, and the SQL each must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import classifier, fill_middle, fingerprint, html_text, jaccard, katz, mixing, packing, sharding, tool_calls, turn_repair, url_filter, weak_rules


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def op1_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix_rows(_table(spark, root, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_urls(spark: SparkSession, root: str) -> DataFrame:
    labels = url_filter.document_labels(_table(spark, root, "labels"))
    return url_filter.filter_urls(_table(spark, root, "pages"), labels)


def op3_html(spark: SparkSession, root: str) -> DataFrame:
    return html_text.main_texts(_table(spark, root, "pages"))


# The tool that a user turn is read as a call of.
REPLY = {"reply": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
                   "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}}


def op4_calls(spark: SparkSession, root: str) -> DataFrame:
    """Every turn of `conversations`: a user turn asks for a reply, the assistant turn right after it is the result."""
    chat = _table(spark, root, "conversations")
    ident = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    call = F.to_json(F.struct(F.array(F.struct(
        ident(F.col("turn")).alias("id"), F.lit("reply").alias("name"),
        F.struct(F.col("text").alias("prompt"), F.col("turn")).alias("arguments"))).alias("tool_calls")))
    result = F.to_json(F.struct(ident(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return tool_calls.linked(chat.withColumn("text", text), REPLY)


def op5_quality(spark: SparkSession, root: str) -> DataFrame:
    return classifier.scored(_table(spark, root, "documents"), _table(spark, root, "labels"))


def op6_jaccard(spark: SparkSession, root: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, root, "documents"))


def op7_shard(spark: SparkSession, root: str) -> DataFrame:
    rows = sharding.shard_rows(_table(spark, root, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op8_pack(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(_table(spark, root, "documents"))


def op9_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, root, "documents"))


def op10_rules(spark: SparkSession, root: str) -> DataFrame:
    return weak_rules.judged(_table(spark, root, "documents"))


def op11_katz(spark: SparkSession, root: str) -> DataFrame:
    train = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) % 10 != 0
    return katz.learn_and_score(_table(spark, root, "documents"), train)[0]


def op12_fill(spark: SparkSession, root: str) -> DataFrame:
    cut = fill_middle.fill_middle(_table(spark, root, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored("output", "form"), 256).alias("restored_sha256"))


def damaged(chat: DataFrame) -> DataFrame:
    """`conversations` with a fifth of the messages spoilt, by a checksum of conversation and turn; nulls become one space."""
    blank = F.lit(" ")
    draw = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    spoilt = chat.select("conv_id", "turn", draw.alias("draw"), role.alias("role"), text.alias("text")).where("draw <> 0")
    return spoilt.select(
        "conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def op13_repair(spark: SparkSession, root: str) -> DataFrame:
    chat = _table(spark, root, "conversations")
    fixed = turn_repair.repair(damaged(chat))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = fixed.report.select(F.col("conv_id").alias("c"), *counts, "audit")
    digests = turn_repair.text_digests(fixed.messages).withColumnRenamed("conv_id", "d")
    every = chat.select("conv_id").distinct()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left") \
        .select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix, "op2_urls": op2_urls, "op3_html": op3_html, "op4_calls": op4_calls, "op5_quality": op5_quality, "op6_jaccard": op6_jaccard, "op7_shard": op7_shard, "op8_pack": op8_pack, "op9_fingerprint": op9_fingerprint, "op10_rules": op10_rules,
    "op11_katz": op11_katz, "op12_fill": op12_fill, "op13_repair": op13_repair,
}
ORACLE_SQL: dict[str, str] = {}

# Mixing, said once more in SQL: whole-table windows in place of the slices.
ORACLE_SQL["op1_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('17/' || coalesce(doc_id::VARCHAR, 'null') || '/' || md5(coalesce(text, ''))), 1, 12))::BIGINT AS k
  FROM documents),
units AS (SELECT doc_id, source, size, k, count(*) AS n, size * count(*) AS words FROM sized GROUP BY doc_id, source, size, k),
totals AS (SELECT source, sum(words)::BIGINT AS source_size FROM units GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         3.0::DOUBLE * source_size AS cap FROM totals),
stepped AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, source COLLATE "C" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap, weight * coalesce(
    (SELECT arg_min(level, ratio) FROM stepped WHERE ratio >= level), 'inf'::DOUBLE)) AS target FROM stepped),
placed AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM units),
epochs AS (
  SELECT p.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source),
dealt AS (
  SELECT *, epochs::BIGINT + (CASE WHEN before + words / 2.0 < target - epochs * source_size THEN 1 ELSE 0 END) AS copies FROM epochs)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies::BIGINT AS copies
FROM (SELECT *, unnest(range(n)) AS nth FROM dealt)
"""

# The same cuts by substr, which counts code points.
ORACLE_SQL["op12_fill"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM hashed),
parts AS (
  SELECT *, substr(text, 1, least(a, b)) AS prefix, substr(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
         substr(text, greatest(a, b) + 1) AS suffix FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""

# CRC-32 of the bytes of an ASCII text, which DuckDB lacks: a table of 256 remainders, then a byte at a time.
CRC32 = r"""
crec AS (
  SELECT [list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS crc_table)"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the SQL expression; `crc_table` must be in scope."""
    steps = f"list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT FOR x IN string_split({text}, '')]), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


def _best_sql(after: str) -> dict[str, str]:
    """Least costs before a message, from those after it (columns {after}0 to {after}3), before insertions."""
    a = [f"{after}{q}" for q in range(4)]
    stays = "(fault < 2)"
    to_user = f"{a[2]} + fault + (CASE WHEN kind = 'u' THEN 0 ELSE 2 END)"
    return {
        "b0": f"least({a[0]} + 3, CASE WHEN {stays} THEN {to_user} ELSE 999999999 END, CASE WHEN {stays} AND kind = 's' THEN {a[1]} + fault ELSE 999999999 END)",
        "b1": f"least({a[1]} + 3, CASE WHEN {stays} THEN {to_user} ELSE 999999999 END)",
        "b2": f"least({a[2]} + 3, CASE WHEN {stays} THEN {a[3]} + fault + (CASE WHEN kind = 'a' THEN 0 ELSE 2 END) ELSE 999999999 END)",
        "b3": f"least({a[3]} + 3, CASE WHEN {stays} THEN {to_user} ELSE 999999999 END)"}


_B = _best_sql("c")
# One pass backward over all vectors, one forward through the least letters; the vectors of a conversation fit a recursive query.
ORACLE_SQL["op13_repair"] = rf"""
WITH RECURSIVE {CRC32.strip()},
drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS d FROM conversations, crec),
spoilt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN d = 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
         regexp_replace(text, '[ 	-
]+\z', '') AS bare FROM spoilt),
coded AS (
  SELECT *, left(role, 1) AS kind, CASE WHEN bare = '' THEN 2 WHEN seen > 1 THEN 3 WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
         row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM placed),
backward AS (
  SELECT conv_id, max(i) + 1 AS i, 0::BIGINT AS c0, 4::BIGINT AS c1, 2::BIGINT AS c2, 0::BIGINT AS c3 FROM coded GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, least(b0, b2 + 2, b3 + 4), least(b1, b2 + 2, b3 + 4), least(b2, b3 + 2), least(b3, b2 + 2)
  FROM (SELECT b.conv_id, c.i, {_B["b0"]} AS b0, {_B["b1"]} AS b1, {_B["b2"]} AS b2, {_B["b3"]} AS b3
        FROM backward b JOIN coded c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.i = b.i - 1)),
costs AS (SELECT conv_id, i, [c0, c1, c2, c3] AS c FROM backward),
steps AS (
  SELECT h.conv_id, h.i, h.c AS here, n.c AS after, m.kind, m.fault, m.role, m.text FROM costs h
  LEFT JOIN costs n ON n.conv_id IS NOT DISTINCT FROM h.conv_id AND n.i = h.i + 1
  LEFT JOIN coded m ON m.conv_id IS NOT DISTINCT FROM h.conv_id AND m.i = h.i),
forward AS (
  SELECT DISTINCT conv_id, 1::BIGINT AS i, 0 AS q, '' AS audit, []::VARCHAR[] AS lines, false AS over FROM coded
  UNION ALL
  SELECT f.conv_id, CASE WHEN e IN ('D', 'K', 'R') THEN f.i + 1 ELSE f.i END, CASE e WHEN 'D' THEN q WHEN 'K' THEN kept WHEN '.' THEN q ELSE nxt END,
         CASE WHEN e = '.' THEN audit ELSE audit || e END,
         CASE e WHEN 'K' THEN list_append(lines, role || ':' || text) WHEN 'R' THEN list_append(lines, made || ':' || text)
                WHEN 'I' THEN list_append(lines, made || ':') ELSE lines END, e = '.'
  FROM (SELECT g.*, CASE WHEN after IS NULL THEN (CASE WHEN q IN (0, 3) THEN '.' ELSE 'I' END)
                    WHEN here[q + 1] = after[q + 1] + 3 THEN 'D'
                    WHEN here[q + 1] = here[nxt + 1] + 2 THEN 'I'
                    WHEN kept IS NOT NULL AND here[q + 1] = after[kept + 1] + fault THEN 'K' ELSE 'R' END AS e
        FROM (SELECT f.*, s.here, s.after, s.fault, s.role, s.text, CASE WHEN q = 2 THEN 3 ELSE 2 END AS nxt, CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END AS made,
                     CASE WHEN kind = 's' AND q = 0 THEN 1 WHEN kind = 'u' AND q <> 2 THEN 2 WHEN kind = 'a' AND q = 2 THEN 3 END AS kept
              FROM forward f JOIN steps s ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i WHERE NOT over) g) f),
done AS (SELECT * FROM forward WHERE over),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
         count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM coded GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(c0, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN backward b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = 1
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
"""
