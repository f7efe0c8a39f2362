"""Projections, predicates and scalar functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates as d
from tallyloom.functions import numbers as n
from tallyloom.functions import records as r
from tallyloom.functions import text as t
from tallyloom.operators import predicates as p
from tallyloom.workload.registry import Tables, query

MONTH = "date_format(o_orderdate, 'yyyy.MM')"


def scalar(name: str, table: str, keys: list[str], make: Callable[[], dict[str, Column]], sql: str) -> None:
    """Register `SELECT keys, expressions FROM table`; `sql` is the list of expressions for DuckDB."""

    def run(tables: Tables) -> DataFrame:
        return getattr(tables, table).select(*keys, *[c.alias(a) for a, c in make().items()])

    query(f"SELECT {', '.join(keys)}, {sql} FROM {table}", name=name)(run)


# --- predicates and projections ---------------------------------------------------------------

scalar("map_priority_codes", "orders", ["o_orderkey"], lambda: {
    "urgency": t.map_code("o_orderpriority", {"1-URGENT": "now", "2-HIGH": "soon"}, F.lit("later")),
    "status_name": t.map_code("o_orderstatus", {"O": "open", "F": "filled"}),
}, """CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE 'later' END AS urgency,
   CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status_name""")

scalar("first_filled_value", "customer", ["c_custkey"], lambda: {
    "non_null": t.first_value_of(F.nullif("c_mktsegment", F.lit("BUILDING")), "c_name"),
    "non_blank": t.first_value_of(F.replace("c_mktsegment", F.lit("MACHINERY"), F.lit(" ")), "c_name",
                                  blank_is_null=True),
}, """coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS non_null,
   CASE WHEN trim(replace(c_mktsegment, 'MACHINERY', ' ')) <> '' THEN replace(c_mktsegment, 'MACHINERY', ' ')
        ELSE c_name END AS non_blank""")

scalar("like_patterns", "part", ["p_partkey"], lambda: {
    "starts_small": F.startswith("p_name", F.lit("small")),
    "has_ring": F.contains("p_name", F.lit("ring")),
    "second_letter_e": F.col("p_name").like("_e%"),
    "not_gear": ~F.col("p_name").like("%gear%"),
    "brand_of_type": F.expr("p_brand like concat('Brand#', cast(p_size as string), '%')"),
    "name_starts_with_first_word": t.starts_with_column("p_name", F.split_part("p_name", F.lit(" "), F.lit(1)), " "),
}, """p_name LIKE 'small%' AS starts_small, p_name LIKE '%ring%' AS has_ring, p_name LIKE '_e%' AS second_letter_e,
   p_name NOT LIKE '%gear%' AS not_gear, p_brand LIKE 'Brand#' || p_size || '%' AS brand_of_type,
   p_name LIKE split_part(p_name, ' ', 1) || ' %' AS name_starts_with_first_word""")

scalar("changed_null_as_blank", "orders", ["o_orderkey"], lambda: {
    "null_vs_blank": t.changed(F.nullif("o_orderstatus", F.lit("P")), F.replace("o_orderstatus", F.lit("P"), F.lit(""))),
    "null_vs_value": t.changed(F.nullif("o_orderstatus", F.lit("P")), "o_orderstatus"),
}, """coalesce(nullif(o_orderstatus, 'P'), '') <> coalesce(replace(o_orderstatus, 'P', ''), '') AS null_vs_blank,
   coalesce(nullif(o_orderstatus, 'P'), '') <> coalesce(o_orderstatus, '') AS null_vs_value""")


@query("""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
          WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
            AND (o_orderstatus, o_orderpriority) IN (('O', '1-URGENT'), ('P', '2-HIGH'), ('F', '5-LOW'))""")
def allow_listed_orders(tb: Tables) -> DataFrame:
    listed = p.allow(tb.orders, {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": []})
    pairs = [("O", "1-URGENT"), ("P", "2-HIGH"), ("F", "5-LOW")]
    return p.allow_tuples(listed, ["o_orderstatus", "o_orderpriority"], pairs).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
          WHERE l_returnflag = 'N' OR l_returnflag = 'A'""")
def live_rows(tb: Tables) -> DataFrame:
    lines = tb.lineitem.withColumn("deleted", F.nullif("l_returnflag", F.lit("A")))
    return p.live(lines, "deleted").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
          WHERE l_discount BETWEEN 0.03 AND 0.05 AND l_quantity BETWEEN 10 AND 20""")
def between_bounds(tb: Tables) -> DataFrame:
    kept = tb.lineitem.filter(F.col("l_discount").between(0.03, 0.05) & F.col("l_quantity").between(10, 20))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT o_orderkey FROM (
            SELECT o_orderkey, strftime(o_orderdate, '%Y.%m') AS s,
                   strftime(o_orderdate + INTERVAL 200 DAY, '%Y.%m') AS e FROM orders)
          WHERE (s >= '1996.03' AND s <= '1997.02') OR e >= '1996.03'""")
def period_on_text_dates(tb: Tables) -> DataFrame:
    spans = tb.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("s"),
                             F.date_format(F.date_add("o_orderdate", 200), "yyyy.MM").alias("e"))
    return spans.filter(d.in_period("s", "e", "1996-03", "1997.02")).select("o_orderkey")


@query("""SELECT n_nationkey, 'dim' AS source, CAST(NULL AS VARCHAR) AS remark, CAST(0 AS BIGINT) AS state,
                 sha256('=' || n_nationkey || chr(1) || '=' || n_name) AS row_key FROM nation""")
def constant_columns(tb: Tables) -> DataFrame:
    out = p.add_constants(tb.nation, {"source": "dim", "remark": (None, "string")})
    return out.withColumns({"state": F.lit(0).cast("long"), "row_key": r.row_id("n_nationkey", "n_name")}).drop(
        "n_name", "n_regionkey")


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_acctbal IS NULL THEN 0.0 ELSE c_acctbal END AS c_acctbal,
                 CASE WHEN c_acctbal < 0 OR c_acctbal IS NULL THEN 'ZEROED' ELSE c_mktsegment END AS c_mktsegment
          FROM customer""")
def set_when_negative(tb: Tables) -> DataFrame:
    bad = (F.col("c_acctbal") < 0) | F.col("c_acctbal").isNull()
    return p.set_when(tb.customer, bad, {"c_acctbal": F.lit(0.0), "c_mktsegment": F.lit("ZEROED")}).select(
        "c_custkey", "c_acctbal", "c_mktsegment")


@query("""SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS order_year
          FROM orders WHERE o_orderstatus <> 'P'""")
def named_steps(tb: Tables) -> DataFrame:
    steps = {
        "drop_pending": lambda df: df.filter("o_orderstatus <> 'P'"),
        "upper_priority": lambda df: df.withColumn("o_orderpriority", F.upper("o_orderpriority")),
        "add_year": lambda df: df.withColumn("order_year", F.year("o_orderdate").cast("long")),
    }
    out = p.apply_steps(tb.orders, ["drop_pending", "upper_priority", "add_year"], steps)
    return out.select("o_orderkey", "o_orderpriority", "order_year")


# --- strings ----------------------------------------------------------------------------------

scalar("fn_substrings", "part", ["p_partkey"], lambda: {
    "head": t.left("p_name", 3), "tail": t.right("p_name", 4), "middle": t.mid("p_name", 2, 5),
}, 'left(p_name, 3) AS head, right(p_name, 4) AS "tail", substr(p_name, 2, 5) AS middle')

scalar("fn_concat", "orders", ["o_orderkey"], lambda: {
    "poisoned": F.concat(F.nullif("o_orderstatus", F.lit("P")), F.lit("/"), "o_orderpriority"),
    "skipped": F.concat_ws("/", F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority"),
}, """nullif(o_orderstatus, 'P') || '/' || o_orderpriority AS poisoned,
   concat_ws('/', nullif(o_orderstatus, 'P'), o_orderpriority) AS skipped""")

scalar("fn_replace", "documents", ["doc_id"], lambda: {
    "n_after": F.length(t.replace_all("text", {"the": "", "\n": " ", "  ": " "})).cast("long"),
}, "CAST(length(replace(replace(replace(text, 'the', ''), chr(10), ' '), '  ', ' ')) AS BIGINT) AS n_after")

scalar("fn_trim", "part", ["p_partkey"], lambda: {
    "both": F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))),
    "front": F.ltrim(F.concat(F.lit("  "), "p_name", F.lit(" "))),
    "back": F.rtrim(F.concat(F.lit("  "), "p_name", F.lit(" "))),
}, """trim('  ' || p_name || ' ') AS both, ltrim('  ' || p_name || ' ') AS front,
   rtrim('  ' || p_name || ' ') AS back""")

scalar("fn_byte_length", "documents", ["doc_id"], lambda: {
    "n_bytes": t.byte_length("text").cast("long"), "n_letters": F.length("text").cast("long"),
}, "CAST(strlen(text) AS BIGINT) AS n_bytes, CAST(length(text) AS BIGINT) AS n_letters")

scalar("fn_upper_pad_instr", "part", ["p_partkey"], lambda: {
    "loud": F.upper("p_name"), "padded": F.rpad("p_name", 14, "."), "at": F.instr("p_name", "e").cast("long"),
}, "upper(p_name) AS loud, rpad(p_name, 14, '.') AS padded, CAST(instr(p_name, 'e') AS BIGINT) AS at")

scalar("fn_substring_index", "documents", ["doc_id"], lambda: {
    "first_words": F.substring_index("text", " ", 2), "last_word": F.substring_index("text", " ", -1),
    "third_word": F.substring_index(F.substring_index("text", " ", 3), " ", -1),
}, """array_to_string(string_split(text, ' ')[:2], ' ') AS first_words, string_split(text, ' ')[-1] AS last_word,
   string_split(text, ' ')[least(3, len(string_split(text, ' ')))] AS third_word""")

scalar("fn_strip_leading_zeros", "customer", ["c_custkey"], lambda: {
    "short_no": t.strip_leading_zeros(F.split_part("c_name", F.lit("#"), F.lit(2))),
}, "ltrim(split_part(c_name, '#', 2), '0') AS short_no")

scalar("fn_canonical_number", "part", ["p_partkey"], lambda: {
    "bare": t.canonical_number(F.concat(F.lit("ZL 20"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"),
                                        F.lit("."), F.col("p_size").cast("string"))),
    "marked": t.between_markers(F.concat(F.lit("No第"), F.col("p_partkey").cast("string"), F.lit("号x")), "第", "号"),
}, """'20' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS bare, CAST(p_partkey AS VARCHAR) AS marked""")

scalar("fn_fold_punctuation", "documents", ["doc_id"], lambda: {
    "folded": t.fold_punctuation(F.translate("text", ",.()", "，。（）")),
}, "text AS folded")

scalar("fn_drop_zero_cents", "part", ["p_partkey"], lambda: {
    "price": t.drop_zero_cents(n.money("p_retailprice")),
}, """CASE WHEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) LIKE '%.00'
        THEN split_part(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', 1)
        ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS price""")

scalar("fn_first_item", "documents", ["doc_id"], lambda: {
    "first_clause": t.first_item("text", ","),
}, "split_part(text, ',', 1) AS first_clause")

scalar("fn_list_length", "documents", ["doc_id"], lambda: {
    "n_clauses": t.list_length("text", ",").cast("long"),
}, "CAST(length(text) - length(replace(text, ',', '')) + 1 AS BIGINT) AS n_clauses")

scalar("fn_tuple_field", "customer", ["c_custkey"], lambda: {
    "segment": t.tuple_field(F.concat_ws(",", F.concat_ws("|", "c_custkey", "c_mktsegment", "c_name"),
                                         F.concat_ws("|", F.lit("x"), "c_name", F.lit("y"))), 2),
    "second_group": t.tuple_field(F.concat_ws(",", F.concat_ws("|", "c_custkey", "c_mktsegment"),
                                              F.concat_ws("|", F.lit("x"), "c_name", F.lit("y"))), 2, 2),
}, "c_mktsegment AS segment, c_name AS second_group")

# --- dates ------------------------------------------------------------------------------------

scalar("fn_reference_day", "orders", ["o_orderkey"], lambda: {
    "days_old": F.datediff(d.day("2001-12-31"), "o_orderdate").cast("long"),
    "is_future": F.col("o_orderdate") > d.day("2000-01-01").cast("timestamp"),
}, """CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS BIGINT) AS days_old,
   o_orderdate > TIMESTAMP '2000-01-01' AS is_future""")

scalar("fn_date_parts", "orders", ["o_orderkey"], lambda: {
    "y": F.year("o_orderdate").cast("long"), "m": F.month("o_orderdate").cast("long"),
    "day_text": F.date_format("o_orderdate", "yyyy-MM-dd"), "month_text": F.date_format("o_orderdate", "yyyy.MM"),
}, """year(o_orderdate) AS y, month(o_orderdate) AS m, strftime(o_orderdate, '%Y-%m-%d') AS day_text,
   strftime(o_orderdate, '%Y.%m') AS month_text""")

scalar("fn_date_shift", "orders", ["o_orderkey"], lambda: {
    "week_before": F.date_format(F.date_sub("o_orderdate", 7), "yyyy-MM-dd"),
    "quarter_later": F.date_format(F.timestamp_add("QUARTER", F.lit(1), "o_orderdate"), "yyyy-MM-dd"),
}, """strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%d') AS week_before,
   strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m-%d') AS quarter_later""")

scalar("fn_days_inclusive", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], lambda: {
    "days": d.days_inclusive(F.date_trunc("month", "l_shipdate"), "l_shipdate").cast("long"),
}, "CAST(date_diff('day', CAST(date_trunc('month', l_shipdate) AS DATE), CAST(l_shipdate AS DATE)) + 1 AS BIGINT) AS days")

scalar("fn_epoch", "events", ["event_id"], lambda: {
    "at": d.epoch_to_text(F.unix_timestamp("ts")),
    "on_day": F.date_format(F.to_date(F.timestamp_seconds(F.unix_timestamp("ts"))), "yyyy-MM-dd"),
}, "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d') AS on_day")

scalar("fn_parse_time", "orders", ["o_orderkey"], lambda: {
    "good": F.date_format(d.parse_time(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")), "yyyyMMdd"),
    "bad_is_null": d.parse_time("o_orderpriority").isNull(),
    "later": F.date_format(F.greatest("o_orderdate", F.lit("1998-01-01").cast("timestamp")), "yyyyMMdd"),
}, """strftime(o_orderdate, '%Y%m%d') AS good, true AS bad_is_null,
   strftime(greatest(o_orderdate, TIMESTAMP '1998-01-01'), '%Y%m%d') AS later""")

scalar("fn_full_years", "orders", ["o_orderkey"], lambda: {
    "years": d.full_years(F.expr(MONTH), d.day("2005-06-15")).cast("long"),
}, "CAST(date_diff('month', date_trunc('month', o_orderdate), TIMESTAMP '2005-06-01') // 12 AS BIGINT) AS years")

scalar("fn_age_by_year", "orders", ["o_orderkey"], lambda: {
    "age": d.age_by_year(F.expr(MONTH), 2010).cast("long"),
    "no_age": d.age_by_year("o_orderpriority", 2010).cast("long"),
}, "2010 - year(o_orderdate) AS age, CAST(NULL AS BIGINT) AS no_age")

scalar("fn_terms", "orders", ["o_orderkey"], lambda: {
    "academic_year": d.academic_year(F.date_format("o_orderdate", "yyyyMM")),
    "term": d.term_number(F.date_format("o_orderdate", "yyyyMM")),
    "year_before": d.previous_term(F.concat_ws("-", F.year("o_orderdate"), F.year("o_orderdate") + 1),
                                   F.month("o_orderdate") % 3 + 1)[0],
    "term_before": d.previous_term(F.concat_ws("-", F.year("o_orderdate"), F.year("o_orderdate") + 1),
                                   F.month("o_orderdate") % 3 + 1)[1].cast("long"),
}, """CASE month(o_orderdate) WHEN 9 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1)
        WHEN 2 THEN (year(o_orderdate) - 1) || '-' || year(o_orderdate)
        WHEN 6 THEN (year(o_orderdate) - 1) || '-' || year(o_orderdate)
        ELSE strftime(o_orderdate, '%Y%m') END AS academic_year,
   CASE month(o_orderdate) WHEN 9 THEN '1' WHEN 2 THEN '2' WHEN 6 THEN '3'
        ELSE strftime(o_orderdate, '%Y%m') END AS term,
   CASE WHEN month(o_orderdate) % 3 = 0 THEN (year(o_orderdate) - 1) || '-' || year(o_orderdate)
        ELSE year(o_orderdate) || '-' || (year(o_orderdate) + 1) END AS year_before,
   CASE WHEN month(o_orderdate) % 3 = 0 THEN 2 ELSE month(o_orderdate) % 3 END AS term_before""")

scalar("fn_calendar_year", "orders", ["o_orderkey"], lambda: {
    "calendar_year": d.calendar_year(F.concat_ws("-", F.year("o_orderdate"), F.year("o_orderdate") + 1),
                                     F.month("o_orderdate") % 3 + 1).cast("long"),
    "month_text": d.year_month(F.year("o_orderdate"), "10"),
}, """CASE WHEN month(o_orderdate) % 3 = 0 THEN year(o_orderdate) ELSE year(o_orderdate) + 1 END AS calendar_year,
   year(o_orderdate) || '.10' AS month_text""")

# partial dates of every length the repair knows
_PARTIAL = """CASE month(o_orderdate) % 6
    WHEN 0 THEN {f}(o_orderdate, '{y}') WHEN 1 THEN {f}(o_orderdate, '{y}{m}')
    WHEN 2 THEN {f}(o_orderdate, '{y}-{m}') WHEN 3 THEN {f}(o_orderdate, '{y}-{m}') || '-'
    WHEN 4 THEN {f}(o_orderdate, '{y}-{m}-{d}') ELSE {f}(o_orderdate, '{y}-{m}-{d}') || ' ' END"""
_SPARK_PARTIAL = _PARTIAL.format(f="date_format", y="yyyy", m="MM", d="dd")
_DUCK_PARTIAL = _PARTIAL.format(f="strftime", y="%Y", m="%m", d="%d")

scalar("fn_repair_date", "orders", ["o_orderkey"], lambda: {
    "raw": F.expr(_SPARK_PARTIAL), "repaired": d.repair_date(F.expr(_SPARK_PARTIAL)),
}, f"""{_DUCK_PARTIAL} AS raw,
   CASE month(o_orderdate) % 6 WHEN 0 THEN strftime(o_orderdate, '%Y')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 3 THEN CASE WHEN month(o_orderdate) < 10 THEN year(o_orderdate) || '-' || month(o_orderdate) || '-'
                     ELSE strftime(o_orderdate, '%Y-%m') || '-' END
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y') END AS repaired""")

scalar("fn_first_year", "orders", ["o_orderkey"], lambda: {
    "first_year": d.first_year(F.when(F.col("o_orderstatus") == "F", F.expr(MONTH)),
                               F.when(F.col("o_orderstatus") == "O", F.lit("19")).otherwise(
                                   F.when(F.col("o_orderstatus") == "P", F.lit("1988.01")))),
}, """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y') WHEN 'P' THEN '1988' ELSE '0' END AS first_year""")

scalar("fn_shift_text_time", "events", ["event_id"], lambda: {
    "hour_ago": d.shift(F.date_format("ts", "yyyy-MM-dd HH"), "HOUR", -1, "yyyy-MM-dd HH"),
    "day_later": d.shift(F.date_format("ts", "yyyy-MM-dd"), "DAY", 1, "yyyy-MM-dd", "yyyyMMdd"),
    "quarter_hour_ago": d.shift(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "MINUTE", -15),
}, """strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H') AS hour_ago,
   strftime(ts + INTERVAL 1 DAY, '%Y%m%d') AS day_later,
   strftime(date_trunc('second', ts) - INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS quarter_hour_ago""")

# --- numbers ----------------------------------------------------------------------------------

scalar("fn_round_floor", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], lambda: {
    "rounded": F.round(n.money("l_extendedprice"), 1).cast("double"),
    "floored": F.floor(n.money("l_extendedprice")).cast("long"),
}, """CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded,
   CAST(floor(CAST(l_extendedprice AS DECIMAL(18,2))) AS BIGINT) AS floored""")

scalar("fn_truncate", "customer", ["c_custkey"], lambda: {
    "cut": n.truncate(n.money("c_acctbal"), 1).cast("double"),
    "cut_negative": n.truncate(-n.money("c_acctbal"), 1).cast("double"),
}, """CAST(CAST(trunc(CAST(c_acctbal AS DECIMAL(18,2)) * 10) AS BIGINT) AS DECIMAL(18,0)) / 10 AS cut,
   CAST(CAST(trunc(-CAST(c_acctbal AS DECIMAL(18,2)) * 10) AS BIGINT) AS DECIMAL(18,0)) / 10 AS cut_negative""")

scalar("fn_ten_thousands", "orders", ["o_orderkey"], lambda: {
    "in_unit": n.to_ten_thousands(n.money("o_totalprice")).cast("double"),
}, "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.0001 AS DECIMAL(6,4)) AS DOUBLE) AS in_unit")

scalar("fn_int_or_zero", "part", ["p_partkey"], lambda: {
    "from_text": n.to_int_or_zero(F.split_part("p_brand", F.lit("#"), F.lit(2))).cast("long"),
    "from_junk": n.to_int_or_zero("p_name").cast("long"),
    "from_mixed": n.to_int_or_zero(F.concat(F.col("p_size").cast("string"), F.lit(" mm"))).cast("long"),
}, """CAST(split_part(p_brand, '#', 2) AS BIGINT) AS from_text, CAST(0 AS BIGINT) AS from_junk,
   CAST(p_size AS BIGINT) AS from_mixed""")

scalar("fn_safe_division", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], lambda: {
    "per_tax": n.safe_div("l_quantity", "l_tax"),
}, "CASE WHEN l_tax = 0 THEN NULL ELSE l_quantity / l_tax END AS per_tax")

scalar("fn_conditionals", "orders", ["o_orderkey"], lambda: {
    "or_default": F.ifnull(F.nullif("o_orderstatus", F.lit("P")), F.lit("?")),
    "picked": F.when(F.col("o_totalprice") > 200000, "big").otherwise("small"),
}, """coalesce(nullif(o_orderstatus, 'P'), '?') AS or_default,
   CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS picked""")

# --- records ----------------------------------------------------------------------------------

scalar("fn_json_round_trip", "events", ["event_id"], lambda: {
    "k": F.from_json("props", "k bigint")["k"],
    "again": F.from_json(F.to_json(F.from_json("props", "k bigint")), "k bigint")["k"],
}, "CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS again")

scalar("fn_json_image", "orders", ["o_orderkey"], lambda: {
    "image": r.json_image("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority"),
}, """'{"o_orderkey":' || o_orderkey || ',"o_orderstatus":' ||
   CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END ||
   ',"o_orderpriority":"' || o_orderpriority || '"}' AS image""")

scalar("fn_row_id", "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], lambda: {
    "row_key": r.row_id("l_orderkey", F.nullif("l_returnflag", F.lit("A"))),
}, """sha256('=' || l_orderkey || chr(1) || CASE WHEN l_returnflag = 'A' THEN '~' ELSE '=' || l_returnflag END) AS row_key""")
