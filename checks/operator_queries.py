"""Every operator on the given tables, beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import job_sql
from checks.registry import Inputs, query
from careloom.functions import clinical, dates, ids, numbers, text
from careloom.operators import claims, codes, coverage, history, lookup, merge, orphans, profile, project, repairs, route, schema
from careloom.operators.collapse import collapse_first
from careloom.operators.dedup import dedup, last_per_key
from careloom.operators.result import TOUCHED
from careloom.plans import batch, chains
from careloom.session import batch_folder
from careloom.sinks.stage import write_stage
from careloom.sources import files, reference

# --- de-duplication ---------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)
RANKED = f"row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_REST})"


@query("dedup_keep_first", f"SELECT * FROM lineitem QUALIFY {RANKED} = 1")
def _(t: Inputs):
    return dedup(t.lineitem, LINE_KEYS).kept


@query("dedup_surplus", f"SELECT * FROM lineitem QUALIFY {RANKED} > 1")
def _(t: Inputs):
    return dedup(t.lineitem, LINE_KEYS).surplus


@query(
    "dedup_key_report",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(t: Inputs):
    return dedup(t.lineitem, LINE_KEYS).key_report


@query(
    "dedup_surplus_copies",
    "SELECT l_returnflag, l_linestatus FROM lineitem "
    "QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_linestatus) > 1",
)
def _(t: Inputs):
    """Three hot keys whose rows are almost all copies."""
    return dedup(t.lineitem.select("l_returnflag", "l_linestatus"), ["l_returnflag"]).surplus


@query(
    "last_per_key_lookup",
    "SELECT c_custkey, c_name, last_order, last_priority FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey AS last_order, "
    "o_orderpriority AS last_priority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, "
    "o_orderkey DESC) = 1) ON c_custkey = o_custkey",
)
def _(t: Inputs):
    return lookup.lookup(
        t.customer, t.orders, {"c_custkey": "o_custkey"},
        {"last_order": "o_orderkey", "last_priority": "o_orderpriority"}, last_by=["o_orderdate", "o_orderkey"],
    ).select("c_custkey", "c_name", "last_order", "last_priority")


@query(
    "last_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1",
)
def _(t: Inputs):
    return last_per_key(t.events, ["user_id", "event_type"], ["ts", "event_id"])


# --- profiles ---------------------------------------------------------------------


def _profile_sql(table: str, columns: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS count, "
        f"round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM {table} GROUP BY 2"
        for c in columns
    ]
    return " UNION ALL ".join(parts)


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
# identifiers are not profiled
EVENT_COLUMNS = ["ts", "event_type", "value", "props"]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate"]
ORDER_CODES = ["o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


@query(
    "value_frequency",
    "SELECT o_orderpriority, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM orders GROUP BY 1",
)
def _(t: Inputs):
    return profile.frequency(t.orders, "o_orderpriority")


@query("distinct_values_profile", _profile_sql("part", PART_COLUMNS))
def _(t: Inputs):
    return profile.value_profile(t.part)


@query(
    "distinct_values_report",
    f"SELECT 'PART' AS \"table\", * FROM ({_profile_sql('part', PART_COLUMNS)}) UNION ALL "
    f"SELECT 'ORDERS', * FROM ({_profile_sql('orders', ORDER_COLUMNS)}) UNION ALL "
    f"SELECT 'EVENTS', * FROM ({_profile_sql('events', EVENT_COLUMNS)})",
)
def _(t: Inputs):
    return batch.distinct_report({"PART": t.part, "ORDERS": t.orders, "EVENTS": t.events})


def _top_sql(table: str, columns: list[str], rows: int) -> str:
    return f"SELECT * FROM ({_profile_sql(table, columns)}) QUALIFY row_number() OVER (PARTITION BY field ORDER BY count DESC, value NULLS FIRST) <= {rows}"


@query("distinct_values_topk", _top_sql("lineitem", LINE_COLUMNS, 100))
def _(t: Inputs):
    return profile.top_profile(t.lineitem, LINE_COLUMNS, 100)


def _month_sql(table: str, column: str) -> str:
    return f"SELECT '{column}' AS field, strftime({column}, '%Y-%m') AS year_month, count(*) AS count FROM {table} GROUP BY 2"


@query("monthly_counts", _month_sql("events", "ts"))
def _(t: Inputs):
    return profile.monthly_counts(t.events, ["ts"])


@query(
    "monthly_counts_report",
    f"SELECT 'ORDERS' AS \"table\", * FROM ({_month_sql('orders', 'o_orderdate')}) UNION ALL "
    f"SELECT 'LINEITEM', * FROM ({_month_sql('lineitem', 'l_shipdate')})",
)
def _(t: Inputs):
    return batch.monthly_report({"ORDERS": t.orders, "LINEITEM": t.lineitem})


@query(
    "monthly_counts_text",
    "SELECT 'SHIP_DATE' AS field, strftime(try_strptime(d, '%m/%d/%Y'), '%Y-%m') AS year_month, count(*) AS count FROM "
    "(SELECT CASE WHEN l_returnflag = 'A' THEN 'bad' ELSE strftime(l_shipdate, '%m/%d/%Y') END AS d FROM lineitem) GROUP BY 2",
)
def _(t: Inputs):
    ship = F.when(F.col("l_returnflag") == "A", "bad").otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    return profile.monthly_counts(t.lineitem.select(ship.alias("SHIP_DATE")))


@query(
    "width_profile",
    "SELECT field, width FROM (UNPIVOT (SELECT max(length(CAST(c_custkey AS VARCHAR))) AS c_custkey, max(length(c_name)) AS c_name, "
    "max(length(CAST(c_nationkey AS VARCHAR))) AS c_nationkey, max(length(c_mktsegment)) AS c_mktsegment, "
    "max(length(CAST(c_acctbal AS VARCHAR))) AS c_acctbal FROM customer) ON c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal INTO NAME field VALUE width)",
)
def _(t: Inputs):
    return profile.width_profile(t.customer).withColumn("width", F.col("width").cast("bigint"))


@query("row_count", "SELECT count(*) AS count FROM lineitem")
def _(t: Inputs):
    return t.lineitem.agg(F.count(F.lit(1)).alias("count"))


@query(
    "top_values",
    "SELECT p_brand, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM part "
    "GROUP BY p_brand ORDER BY count DESC, p_brand LIMIT 10",
)
def _(t: Inputs):
    return profile.top_values(t.part, "p_brand", 10)


# --- dictionaries, built from the parts --------------------------------------------

# brands stand for codes: some mapped, some to a flavour of null, some not at all
DICTIONARY = """SELECT DISTINCT 'LINES' AS "table", 'BRAND' AS field, lower(p_brand) AS source_value,
    CASE WHEN p_brand LIKE '%3' THEN 'NI' WHEN p_brand LIKE '%4' THEN '' WHEN p_brand LIKE '%5' THEN NULL
    ELSE 'B' || substr(p_brand, 7) END AS target_value FROM {part} WHERE p_brand NOT LIKE '%1'
    UNION ALL SELECT DISTINCT 'LINES', 'TYPE_UNIT', p_type, substr(p_type, 1, 2) FROM {part} WHERE p_type <> 'PROMO'
    UNION ALL SELECT DISTINCT 'PARTS', 'TYPE', p_type, 'T' FROM {part}"""
DICTIONARY_DUCK = DICTIONARY.replace("{part}", "part")
VALUESET = "SELECT DISTINCT 'BRAND' AS FIELD_NAME, ' ' || p_brand || ' ' AS VALUESET_ITEM FROM {part} WHERE p_brand LIKE '%21'"
CODED_LINES = (
    "SELECT l_orderkey, l_linenumber, p_brand AS BRAND, CASE WHEN l_linenumber = 1 THEN lower(p_type) ELSE p_type END "
    "AS TYPE_UNIT FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey"
)
LINES_DUCK = CODED_LINES.replace("{", "").replace("}", "")


def _dictionary(t: Inputs):
    return codes.checked(t.view(DICTIONARY.replace('"table"', "`table`")))


def _found(field: str, key: str, stored: str) -> str:
    return (
        f"(SELECT max(target_value) FROM d WHERE \"table\" = 'LINES' AND field = '{field}' AND {stored} = {key})"
    )


@query(
    "code_map_fallback",
    f"WITH d AS ({DICTIONARY_DUCK}) SELECT l_orderkey, l_linenumber, "
    f"coalesce({_found('BRAND', 'upper(BRAND)', 'upper(source_value)')}, BRAND) AS BRAND, TYPE_UNIT FROM ({LINES_DUCK})",
)
def _(t: Inputs):
    return codes.map_codes(t.view(CODED_LINES), _dictionary(t), "LINES", ["BRAND"])


@query(
    "code_map_case_sensitive",
    f"WITH d AS ({DICTIONARY_DUCK}) SELECT l_orderkey, l_linenumber, BRAND, "
    f"coalesce({_found('TYPE_UNIT', 'TYPE_UNIT', 'source_value')}, TYPE_UNIT) AS TYPE_UNIT FROM ({LINES_DUCK})",
)
def _(t: Inputs):
    return codes.map_codes(
        t.view(CODED_LINES), _dictionary(t), "LINES", ["TYPE_UNIT"], case_sensitive=["TYPE_UNIT"]
    )


@query(
    "code_map_strict",
    f"WITH d AS ({DICTIONARY_DUCK}) SELECT l_orderkey, l_linenumber, "
    f"{_found('BRAND', 'upper(BRAND)', 'upper(source_value)')} AS BRAND, TYPE_UNIT FROM ({LINES_DUCK})",
)
def _(t: Inputs):
    return codes.map_codes(t.view(CODED_LINES), _dictionary(t), "LINES", ["BRAND"], "strict")


# a dictionary with an entry for nearly every part
NAMES = """SELECT 'LINES' AS "table", 'PIECE' AS field, CASE WHEN p_size > 25 THEN upper(p_name || p_partkey) ELSE lower(p_name || p_partkey) END AS source_value,
    'N' || p_size AS target_value FROM {part} WHERE p_size <> 7"""
NAMED_LINES = "SELECT l_orderkey, l_linenumber, p_name || l_partkey AS PIECE FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey"
_NAMED = NAMED_LINES.replace("{", "").replace("}", "")
_NAME_OF = "(SELECT 'N' || p_size FROM part WHERE upper(p_name || p_partkey) = upper(PIECE) AND p_size <> 7)"


def _large_map(t: Inputs, mode: str):
    entries = codes.checked(t.view(NAMES.replace('"table"', "`table`")))
    return codes.map_codes(t.view(NAMED_LINES), entries, "LINES", ["PIECE"], mode)


@query("code_map_large", f"SELECT l_orderkey, l_linenumber, coalesce({_NAME_OF}, PIECE) AS PIECE FROM ({_NAMED})")
def _(t: Inputs):
    return _large_map(t, "fallback")


@query("code_map_large_strict", f"SELECT l_orderkey, l_linenumber, {_NAME_OF} AS PIECE FROM ({_NAMED})")
def _(t: Inputs):
    return _large_map(t, "strict")


COVERED = (
    f"SELECT field, value, target, count, percent FROM (SELECT field, value, (SELECT max(target_value) FROM ({DICTIONARY_DUCK}) d "
    "WHERE d.\"table\" = 'LINES' AND d.field = p.field AND CASE WHEN d.field = 'TYPE_UNIT' THEN d.source_value = p.value "
    "ELSE upper(d.source_value) = upper(p.value) END) AS target, count, percent FROM "
    f"({_profile_sql(f'({LINES_DUCK})', ['BRAND', 'TYPE_UNIT'])}) p)"
)
MISSING = (
    f"SELECT * FROM ({COVERED}) WHERE target IS NULL AND value IS NOT NULL AND (field, value) NOT IN "
    "(SELECT ('BRAND', p_brand) FROM part WHERE p_brand LIKE '%21')"
)


def _coverage(t: Inputs):
    return coverage.coverage(t.view(CODED_LINES), _dictionary(t), "LINES", ["BRAND", "TYPE_UNIT"])


@query("mapping_coverage", COVERED)
def _(t: Inputs):
    return _coverage(t)


@query("missing_mapping", MISSING)
def _(t: Inputs):
    return coverage.missing_mapping(_coverage(t), t.view(VALUESET))


@query(
    "flavour_of_null",
    f"SELECT * FROM ({DICTIONARY_DUCK}) WHERE target_value IN ('NI', 'OT', 'UN') OR target_value IS NULL OR target_value = ''",
)
def _(t: Inputs):
    return coverage.flavours_of_null(_dictionary(t))


_KEY = "'\"' || CASE WHEN contains(field, 'UNIT') THEN source_value ELSE upper(source_value) END || '\"'"
_MARKED = f"CASE WHEN coalesce(target_value, '') = '' THEN '# ' || {_KEY} ELSE {_KEY} END"


@query(
    "suggested_dictionary",
    f"SELECT *, '       ' || rpad({_MARKED}, greatest(20, length({_MARKED}))::INT, ' ') || '  :  \"' || coalesce(target_value, '') || '\",' "
    f"AS entry FROM (SELECT field, source_value, target_value FROM ({DICTIONARY_DUCK}) WHERE \"table\" = 'LINES' "
    f"UNION ALL SELECT field, value, '' FROM ({MISSING}))",
)
def _(t: Inputs):
    missing = coverage.missing_mapping(_coverage(t), t.view(VALUESET))
    return coverage.suggest_codes(_dictionary(t), missing, "LINES")


@query(
    "mapping_report",
    f"SELECT 'LINES' AS \"table\", * FROM ({COVERED}) UNION ALL SELECT 'PARTS', field, value, 'T', count, percent FROM "
    f"({_profile_sql('(SELECT p_type AS TYPE FROM part)', ['TYPE'])})",
)
def _(t: Inputs):
    tables = {"LINES": t.view(CODED_LINES), "PARTS": t.view("SELECT p_type AS TYPE FROM {part}")}
    return batch.mapping_gap(tables, _dictionary(t), t.view(VALUESET))["all_mapping"]


@query(
    "colliding_dictionary_keys",
    "SELECT 'P' AS \"table\", 'NAME' AS field, upper(p_name) AS key, count(*) AS entries FROM part GROUP BY 3 HAVING count(*) > 1",
)
def _(t: Inputs):
    raw = t.part.select(
        F.lit("P").alias("table"), F.lit("NAME").alias("field"), F.col("p_name").alias("source_value"),
        F.col("p_type").alias("target_value"),
    )
    return codes.colliding_entries(raw)


@query("value_set_items", "SELECT DISTINCT p_brand AS VALUESET_ITEM FROM part WHERE p_brand LIKE '%21'")
def _(t: Inputs):
    return reference.value_items(t.view(VALUESET), "BRAND")


@query("tables_with_field", "SELECT DISTINCT p_type AS TABLE_NAME FROM part WHERE contains(p_name, 'ring')")
def _(t: Inputs):
    return reference.tables_with_field(t.part.select(F.col("p_type").alias("TABLE_NAME"), F.col("p_name").alias("FIELD_NAME")), "ring")


# --- orphans and parents -----------------------------------------------------------

GOOD_CUSTOMERS = "SELECT c_custkey FROM customer WHERE c_acctbal >= 0"
OPEN_ORDERS = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'"


def _customers(t: Inputs):
    return t.customer.where("c_acctbal >= 0")


def _open_orders(t: Inputs):
    return t.orders.where("o_orderstatus = 'O'")


@query("orphan_drop", f"SELECT * FROM orders WHERE o_custkey IN ({GOOD_CUSTOMERS})")
def _(t: Inputs):
    return orphans.drop_orphans(t.orders, _customers(t), "o_custkey", "c_custkey").good


@query("orphan_drop_rejects", f"SELECT * FROM orders WHERE o_custkey NOT IN ({GOOD_CUSTOMERS})")
def _(t: Inputs):
    return orphans.drop_orphans(t.orders, _customers(t), "o_custkey", "c_custkey").rejects


@query("orphan_keys", f"SELECT o_custkey FROM orders EXCEPT ({GOOD_CUSTOMERS})")
def _(t: Inputs):
    return orphans.drop_orphans(t.orders, _customers(t), "o_custkey", "c_custkey").report


NULLED = "SELECT * REPLACE (CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS l_orderkey) FROM lineitem"


def _nulled(t: Inputs):
    return t.lineitem.withColumn("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")))


@query(
    "orphan_nullify",
    f"SELECT * REPLACE (CASE WHEN l_orderkey IN ({OPEN_ORDERS}) THEN l_orderkey END AS l_orderkey) FROM ({NULLED})",
)
def _(t: Inputs):
    return orphans.nullify_orphans(_nulled(t), _open_orders(t), "l_orderkey", "o_orderkey").good


@query("orphan_nullify_rejects", f"SELECT * FROM ({NULLED}) WHERE l_orderkey NOT IN ({OPEN_ORDERS})")
def _(t: Inputs):
    return orphans.nullify_orphans(_nulled(t), _open_orders(t), "l_orderkey", "o_orderkey").rejects


@query(
    "orphan_counts",
    f"SELECT l_orderkey, count(*) AS count FROM ({NULLED}) WHERE l_orderkey NOT IN ({OPEN_ORDERS}) GROUP BY 1",
)
def _(t: Inputs):
    return orphans.nullify_orphans(_nulled(t), _open_orders(t), "l_orderkey", "o_orderkey").report


CHILD = "SELECT l_orderkey AS k, l_linenumber, l_shipdate AS day, l_linestatus AS status FROM lineitem"
PARENT = "SELECT o_orderkey AS k, o_orderdate AS day, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'"


def _replicated(t: Inputs, how: str = "left"):
    child = t.lineitem.selectExpr("l_orderkey AS k", "l_linenumber", "l_shipdate AS day", "l_linestatus AS status")
    parent = t.orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey AS k", "o_orderdate AS day", "o_orderstatus AS status")
    return orphans.replicate(child, parent, "k", ["day", "status"], how=how)


@query("replicate_attributes", f"SELECT c.k, l_linenumber, p.day, p.status FROM ({CHILD}) c LEFT JOIN ({PARENT}) p ON c.k = p.k")
def _(t: Inputs):
    return _replicated(t).good


@query("replicate_inner", f"SELECT c.k, l_linenumber, p.day, p.status FROM ({CHILD}) c JOIN ({PARENT}) p ON c.k = p.k")
def _(t: Inputs):
    return _replicated(t, "inner").good


@query(
    "replicate_disagreements",
    f"SELECT c.*, p.day AS SOURCE_day, p.status AS SOURCE_status FROM ({CHILD}) c JOIN ({PARENT}) p ON c.k = p.k "
    "WHERE c.day <> p.day OR c.status <> p.status",
)
def _(t: Inputs):
    return _replicated(t).rejects


# --- row repairs -------------------------------------------------------------------

HOLES = "SELECT * REPLACE (nullif(event_type, 'error') AS event_type) FROM events"


def _holes(t: Inputs):
    return t.events.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


@query("copy_when_null", f"SELECT * REPLACE (coalesce(event_type, props) AS event_type) FROM ({HOLES})")
def _(t: Inputs):
    return repairs.copy_when_null(_holes(t), "event_type", "props").good


@query("copy_when_null_rejects", f"SELECT * FROM ({HOLES}) WHERE event_type IS NULL")
def _(t: Inputs):
    return repairs.copy_when_null(_holes(t), "event_type", "props").rejects


@query("delete_when_null", f"SELECT * FROM ({HOLES}) WHERE event_type IS NOT NULL")
def _(t: Inputs):
    return repairs.delete_when_null(_holes(t), "event_type").good


@query("delete_when_null_rejects", f"SELECT * FROM ({HOLES}) WHERE event_type IS NULL")
def _(t: Inputs):
    return repairs.delete_when_null(_holes(t), "event_type").rejects


VALID_TYPES = "SELECT DISTINCT event_type FROM events WHERE value > 100 AND event_type IN ('click', 'view')"


def _valid_types(t: Inputs):
    return t.events.where("value > 100 AND event_type IN ('click', 'view')").select(
        F.concat(F.col("event_type"), F.lit(" ")).alias("VALUESET_ITEM")
    )


@query(
    "invalid_to_null",
    f"SELECT * REPLACE (CASE WHEN event_type IN ({VALID_TYPES}) THEN event_type END AS event_type) FROM ({HOLES})",
)
def _(t: Inputs):
    return repairs.invalid_to_null(_holes(t), "event_type", _valid_types(t)).good


@query("invalid_to_null_rejects", f"SELECT * FROM ({HOLES}) WHERE event_type IS NOT NULL AND event_type NOT IN ({VALID_TYPES})")
def _(t: Inputs):
    return repairs.invalid_to_null(_holes(t), "event_type", _valid_types(t)).rejects


STAYS = (
    "SELECT l_orderkey, l_linenumber, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ADMIT_DATE, CASE WHEN l_linenumber = 2 "
    "THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS PX_DATE FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
)
STAYS_DUCK = STAYS.replace("{", "").replace("}", "")
EARLY = "date_diff('day', TRY_CAST(PX_DATE AS DATE), TRY_CAST(ADMIT_DATE AS DATE)) > 5"


@query("illogical_date", f"SELECT * REPLACE (CASE WHEN {EARLY} THEN ADMIT_DATE ELSE PX_DATE END AS PX_DATE) FROM ({STAYS_DUCK})")
def _(t: Inputs):
    return repairs.clamp_early_date(t.view(STAYS), "PX_DATE").good


@query("illogical_date_rejects", f"SELECT * FROM ({STAYS_DUCK}) WHERE {EARLY}")
def _(t: Inputs):
    return repairs.clamp_early_date(t.view(STAYS), "PX_DATE").rejects


LISTED = "SELECT p_brand FROM part WHERE p_size >= 50"
BRANDED = "SELECT * REPLACE (CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS p_brand) FROM part"


def _listed(t: Inputs):
    branded = t.part.withColumn("p_brand", F.when(F.col("p_type") != "PROMO", F.col("p_brand")))
    return repairs.remove_listed(branded, "p_brand", t.part.where("p_size >= 50").select("p_brand"))


@query("list_remove", f"SELECT * FROM ({BRANDED}) WHERE p_brand IS NULL OR p_brand NOT IN ({LISTED})")
def _(t: Inputs):
    return _listed(t).good


@query("list_remove_rejects", f"SELECT * FROM ({BRANDED}) WHERE p_brand IN ({LISTED})")
def _(t: Inputs):
    return _listed(t).rejects


PATTERNS = ("license", "@", "(", "ENEUX", "[", "the and", "http", r"t\E the", r"\Q")
HIT = "(" + " OR ".join(f"contains(lower(text), lower('{p}'))" for p in PATTERNS) + ")"
TEXTS = r"SELECT doc_id, lang, nullif(CASE WHEN doc_id % 7 = 0 THEN replace(text, 't the', 't\E the') ELSE text END, '') AS text FROM documents"


def _patterned(t: Inputs):
    marked = F.when(F.col("doc_id") % 7 == 0, F.replace("text", F.lit("t the"), F.lit(r"t\E the"))).otherwise(F.col("text"))
    docs = t.documents.select("doc_id", "lang", F.nullif(marked, F.lit("")).alias("text"))
    return repairs.remove_patterns(docs, "text", t.spark.createDataFrame([(p,) for p in PATTERNS], "pattern STRING"))


@query("pattern_remove", f"SELECT * FROM ({TEXTS}) WHERE text IS NULL OR NOT {HIT}")
def _(t: Inputs):
    return _patterned(t).good


@query("pattern_remove_rejects", f"SELECT * FROM ({TEXTS}) WHERE {HIT}")
def _(t: Inputs):
    return _patterned(t).rejects


WORTH = "SELECT o_orderkey, 'Customer ' || o_custkey || ' worth ' || CAST(floor(o_totalprice) AS BIGINT) AS text FROM orders"
LISTED_WORTH = "SELECT DISTINCT 'MER ' || o_custkey || ' Worth ' || CAST(floor(o_totalprice / 10000) AS BIGINT) AS p FROM orders WHERE o_orderstatus = 'F'"
WORTH_HIT = f"EXISTS (SELECT 1 FROM ({LISTED_WORTH}) WHERE contains(lower(text), lower(p)))"


def _long_list(t: Inputs):
    """As many texts to remove as there are finished orders."""
    worth = "CAST(floor({}) AS BIGINT)"
    texts = t.orders.selectExpr("o_orderkey", f"concat('Customer ', o_custkey, ' worth ', {worth.format('o_totalprice')}) AS text")
    listed = t.orders.where("o_orderstatus = 'F'").selectExpr(f"concat('MER ', o_custkey, ' Worth ', {worth.format('o_totalprice / 10000')}) AS p")
    return repairs.remove_patterns(texts, "text", listed.distinct())


@query("pattern_remove_large", f"SELECT * FROM ({WORTH}) WHERE NOT {WORTH_HIT}")
def _(t: Inputs):
    return _long_list(t).good


@query("pattern_remove_large_rejects", f"SELECT * FROM ({WORTH}) WHERE {WORTH_HIT}")
def _(t: Inputs):
    return _long_list(t).rejects


@query(
    "predicate_suite",
    "SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_quantity > 25 THEN 'many' ELSE 'few' END AS size FROM lineitem "
    "WHERE l_returnflag IN ('A', 'R') AND l_linenumber NOT IN (3, 4) AND trim(l_linestatus) IN ('F', 'O') "
    "AND (l_tax <> 0.02 OR l_tax IS NULL)",
)
def _(t: Inputs):
    keep = F.col("l_returnflag").isin("A", "R") & ~F.col("l_linenumber").isin(3, 4) & F.trim("l_linestatus").isin("F", "O")
    differs = (F.col("l_tax") != 0.02) | F.col("l_tax").isNull()
    size = F.when(F.col("l_quantity") > 25, "many").otherwise("few").alias("size")
    return t.lineitem.where(keep & differs).select("l_orderkey", "l_linenumber", "l_returnflag", size)


# --- routing -----------------------------------------------------------------------

_LINE = "CAST(l_orderkey * 10 + l_linenumber AS STRING)"
RESULT_TABLES = {
    route.LAB: f"""SELECT {_LINE} AS LAB_RESULT_CM_ID, CAST(l_partkey AS STRING) AS LAB_LOINC, l_linestatus AS LAB_RESULT_SOURCE,
        'px' AS LAB_PX_TYPE, CAST(l_suppkey AS STRING) AS RESULT_QUAL, 'lab' AS RAW_LAB_NAME FROM {{lineitem}} WHERE l_returnflag = 'N'""",
    route.CLIN: f"""SELECT {_LINE} AS OBSCLINID, CAST(l_partkey AS STRING) AS OBSCLIN_CODE, CASE WHEN l_linestatus = 'O' THEN 'OD' ELSE 'HC' END
        AS OBSCLIN_SOURCE, CASE WHEN l_linenumber > 3 THEN 'LC' ELSE 'SM' END AS OBSCLIN_TYPE, CAST(l_suppkey AS STRING) AS OBSCLIN_RESULT_QUAL,
        'clin' AS RAW_OBSCLIN_NAME FROM {{lineitem}} WHERE l_returnflag = 'A'""",
    route.GEN: f"""SELECT {_LINE} AS OBSGENID, CAST(l_partkey AS STRING) AS OBSGEN_CODE, 'OD' AS OBSGEN_SOURCE,
        CASE WHEN l_linenumber > 3 THEN 'LC' ELSE 'SM' END AS OBSGEN_TYPE, CAST(l_suppkey AS STRING) AS OBSGEN_RESULT_QUAL,
        'gen' AS RAW_OBSGEN_NAME FROM {{lineitem}} WHERE l_returnflag = 'R'""",
}
FLAGS = """SELECT CAST(p_partkey AS STRING) AS loinc_num, CASE WHEN p_size > 35 THEN '1' ELSE '0' END AS found_in_lab,
    CASE WHEN p_type IN ('LARGE', 'PROMO') THEN '1' ELSE '0' END AS found_in_obs_clin,
    CASE WHEN p_type IN ('SMALL', 'PROMO') THEN '1' ELSE '0' END AS found_in_obs_gen FROM {part} WHERE p_type <> 'ECONOMY'"""
CLASSES = "SELECT CAST(p_partkey AS STRING) AS loinc_num, CAST(p_size % 5 AS STRING) AS classtype FROM {part} WHERE p_type <> 'ECONOMY'"
TOGETHER = (
    "SELECT LAB_RESULT_CM_ID AS ID, LAB_LOINC AS CODE, LAB_RESULT_SOURCE AS RESULT_SOURCE, LAB_PX_TYPE, RESULT_QUAL, "
    f"RAW_LAB_NAME AS RAW_NAME, NULL::VARCHAR AS TYPE, 'LAB_RESULT_CM' AS home FROM ({RESULT_TABLES[route.LAB]}) UNION ALL "
    "SELECT OBSCLINID, OBSCLIN_CODE, OBSCLIN_SOURCE, NULL, OBSCLIN_RESULT_QUAL, RAW_OBSCLIN_NAME, OBSCLIN_TYPE, 'OBS_CLIN' "
    f"FROM ({RESULT_TABLES[route.CLIN]}) UNION ALL SELECT OBSGENID, OBSGEN_CODE, OBSGEN_SOURCE, NULL, OBSGEN_RESULT_QUAL, "
    f"RAW_OBSGEN_NAME, OBSGEN_TYPE, 'OBS_GEN' FROM ({RESULT_TABLES[route.GEN]})"
).replace("{lineitem}", "lineitem")
# by flags, the code type of the lab table is that of the others
TYPED = f"SELECT * EXCLUDE (LAB_PX_TYPE) REPLACE (coalesce(TYPE, LAB_PX_TYPE) AS TYPE) FROM ({TOGETHER})"
BY_FLAGS = (
    f"SELECT r.*, CASE WHEN found_in_lab = '1' THEN 'LAB_RESULT_CM' WHEN found_in_obs_clin = '1' THEN 'OBS_CLIN' "
    f"WHEN found_in_obs_gen = '1' THEN 'OBS_GEN' ELSE home END AS dest, loinc_num FROM ({TYPED}) r "
    f"LEFT JOIN ({FLAGS.replace('{part}', 'part')}) ON CODE = loinc_num"
)
BY_CLASS = (
    f"SELECT r.*, CASE WHEN home = 'LAB_RESULT_CM' AND classtype = '2' THEN 'OBS_CLIN' "
    "WHEN home = 'LAB_RESULT_CM' AND classtype IN ('3', '4') THEN 'OBS_GEN' "
    "WHEN home = 'OBS_CLIN' AND classtype = '1' AND TYPE = 'LC' THEN 'LAB_RESULT_CM' "
    "WHEN home = 'OBS_GEN' AND classtype = '1' AND TYPE = 'LC' THEN 'LAB_RESULT_CM' "
    "WHEN home = 'OBS_CLIN' AND classtype IN ('3', '4') AND TYPE = 'LC' THEN 'OBS_GEN' ELSE home END AS dest "
    f"FROM ({TOGETHER}) r LEFT JOIN ({CLASSES.replace('{part}', 'part')}) ON CODE = loinc_num"
)
RECODED = "CASE WHEN dest = 'OBS_CLIN' AND RESULT_SOURCE = 'OD' AND loinc_num IS NOT NULL THEN 'DR' ELSE RESULT_SOURCE END"


def _tables(t: Inputs):
    return {name: t.view(sql) for name, sql in RESULT_TABLES.items()}


def _named(df):
    return df.withColumnsRenamed({route.HOME: "home", route.DESTINATION: "dest"})


@query(
    "route_by_flags",
    f"SELECT ID, CODE, {RECODED} AS RESULT_SOURCE, RESULT_QUAL, RAW_NAME, TYPE, home, dest FROM ({BY_FLAGS})",
)
def _(t: Inputs):
    return _named(route.route(_tables(t), t.view(FLAGS)))


@query(
    "route_by_flags_copies",
    f"SELECT * EXCLUDE (loinc_num) REPLACE ({RECODED} AS RESULT_SOURCE) FROM (SELECT r.*, unnest(list_filter([CASE WHEN found_in_lab = '1' "
    "THEN 'LAB_RESULT_CM' END, CASE WHEN found_in_obs_clin = '1' THEN 'OBS_CLIN' END, CASE WHEN found_in_obs_clin = '0' AND found_in_obs_gen = '1' "
    f"THEN 'OBS_GEN' END, CASE WHEN loinc_num IS NULL THEN home END], lambda x: x IS NOT NULL)) AS dest, loinc_num FROM ({TYPED}) r "
    f"LEFT JOIN ({FLAGS.replace('{part}', 'part')}) ON CODE = loinc_num)",
)
def _(t: Inputs):
    return _named(route.route(_tables(t), t.view(FLAGS), copies=True))


@query(
    "route_by_flags_obs_clin",
    f"SELECT ID AS OBSCLINID, CODE AS OBSCLIN_CODE, {RECODED} AS OBSCLIN_SOURCE, TYPE AS OBSCLIN_TYPE, RESULT_QUAL AS OBSCLIN_RESULT_QUAL, "
    f"RAW_NAME AS RAW_OBSCLIN_NAME FROM ({BY_FLAGS}) WHERE dest = 'OBS_CLIN'",
)
def _(t: Inputs):
    tables = _tables(t)
    return route.from_common(route.route(tables, t.view(FLAGS)), route.CLIN, tables[route.CLIN].columns)


@query(
    "route_by_flags_lab",
    f"SELECT ID AS LAB_RESULT_CM_ID, CODE AS LAB_LOINC, {RECODED} AS LAB_RESULT_SOURCE, TYPE AS LAB_PX_TYPE, RESULT_QUAL, RAW_NAME AS RAW_LAB_NAME "
    f"FROM ({BY_FLAGS}) WHERE dest = 'LAB_RESULT_CM'",
)
def _(t: Inputs):
    tables = _tables(t)
    return route.from_common(route.route(tables, t.view(FLAGS)), route.LAB, tables[route.LAB].columns)


MOVED_OUT = "home = 'LAB_RESULT_CM' AND dest <> home"


@query(
    "route_by_class",
    f"SELECT ID, CODE, CASE WHEN {MOVED_OUT} THEN 'HC' ELSE RESULT_SOURCE END AS RESULT_SOURCE, LAB_PX_TYPE, RESULT_QUAL, RAW_NAME, "
    f"CASE WHEN {MOVED_OUT} THEN 'LC' ELSE TYPE END AS TYPE, home, dest FROM ({BY_CLASS})",
)
def _(t: Inputs):
    return _named(route.move_by_class(_tables(t), t.view(CLASSES)))


@query(
    "moved_report",
    " UNION ALL ".join(
        f"SELECT '{s} -> {d}' AS step, '{s}' AS source_table, '{d}' AS target_table, count(*) FILTER (WHERE home = '{s}' AND dest = '{d}') "
        f"AS records_moved FROM ({BY_CLASS})"
        for s, d in route.MOVES
    ),
)
def _(t: Inputs):
    return route.moved_report(route.move_by_class(_tables(t), t.view(CLASSES)))


# --- history, merge ----------------------------------------------------------------

ADDRESSES = (
    "SELECT CAST(o_orderkey AS STRING) AS ADDRESSID, CAST(o_custkey AS STRING) AS PATID, CASE WHEN o_orderkey % 13 = 0 THEN NULL "
    "ELSE o_orderpriority END AS ADDRESS_ZIP5, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END "
    "AS ADDRESS_PERIOD_START, CAST(NULL AS STRING) AS ADDRESS_PERIOD_END FROM {orders} WHERE "
)
# the two overlap in time, each has patients of its own, and together they are all orders
HELD = "(o_orderstatus = 'F' OR o_custkey % 10 = 1 OR o_orderkey % 2 = 0) AND o_custkey % 10 <> 0"
EXISTING = ADDRESSES + HELD
INCOMING = ADDRESSES + f"NOT ({HELD})"
_E, _N = EXISTING.replace("{orders}", "orders"), INCOMING.replace("{orders}", "orders")
_CLOSED_START = (
    "(SELECT min(n.ADDRESS_PERIOD_START) FROM n WHERE n.PATID = e.PATID AND (n.ADDRESS_ZIP5 <> e.ADDRESS_ZIP5 OR e.ADDRESS_ZIP5 IS NULL))"
)
_SAME = "n.PATID = e.PATID AND n.ADDRESS_ZIP5 = e.ADDRESS_ZIP5"


def _later(a: str, b: str) -> str:
    return f"CASE WHEN {a} < {b} THEN {b} ELSE {a} END"


def _parity_sql(fresh: str) -> str:
    first = f"(SELECT min(n.ADDRESS_PERIOD_START) FROM n WHERE {_SAME})"
    last = f"(SELECT max(n.ADDRESS_PERIOD_START) FROM n WHERE {_SAME})"
    start = "ADDRESS_PERIOD_START"
    return (
        f"WITH e AS ({_E}), n AS ({_N}) SELECT * FROM e WHERE PATID NOT IN (SELECT PATID FROM n) UNION ALL "
        f"SELECT * REPLACE ({_later('e.' + start, _CLOSED_START)} AS ADDRESS_PERIOD_END) FROM e WHERE EXISTS (SELECT 1 FROM n WHERE "
        "n.PATID = e.PATID AND (n.ADDRESS_ZIP5 <> e.ADDRESS_ZIP5 OR e.ADDRESS_ZIP5 IS NULL)) UNION ALL "
        f"SELECT * REPLACE (CASE WHEN {first} <= e.{start} THEN {first} ELSE e.{start} END AS {start}, {_later('e.' + start, last)} AS ADDRESS_PERIOD_END) "
        f"FROM e WHERE EXISTS (SELECT 1 FROM n WHERE {_SAME}) UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE {fresh})"
    )


def _history_sql(fresh: str) -> str:
    """The rule: every existing row once; a missing zip equals a missing zip."""
    return f"""WITH e AS ({_E}), n AS ({_N}),
    same AS (SELECT PATID, ADDRESS_ZIP5, min(ADDRESS_PERIOD_START) AS first, max(ADDRESS_PERIOD_START) AS last FROM n GROUP BY ALL),
    beside AS (SELECT e.*, s.PATID IS NOT NULL AS again, first, last, (SELECT min(n.ADDRESS_PERIOD_START) FROM n WHERE n.PATID = e.PATID
        AND (e.ADDRESS_PERIOD_START IS NULL OR n.ADDRESS_PERIOD_START > e.ADDRESS_PERIOD_START)) AS following
        FROM e LEFT JOIN same s ON s.PATID = e.PATID AND s.ADDRESS_ZIP5 IS NOT DISTINCT FROM e.ADDRESS_ZIP5)
    SELECT ADDRESSID, PATID, ADDRESS_ZIP5, CASE WHEN again THEN least(ADDRESS_PERIOD_START, first) ELSE ADDRESS_PERIOD_START END AS ADDRESS_PERIOD_START,
        CASE WHEN again THEN greatest(ADDRESS_PERIOD_START, last) ELSE coalesce(following, ADDRESS_PERIOD_END) END AS ADDRESS_PERIOD_END FROM beside
    UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM e WHERE {fresh})"""


_KNOWN = "e.PATID IS NOT DISTINCT FROM n.PATID"


@query("history_merge", _history_sql(f"{_KNOWN} AND e.ADDRESS_ZIP5 IS NOT DISTINCT FROM n.ADDRESS_ZIP5"))
def _(t: Inputs):
    return history.merge_history(t.view(EXISTING), t.view(INCOMING))


@query("history_merge_known_entities", _history_sql(_KNOWN))
def _(t: Inputs):
    return history.merge_history(t.view(EXISTING), t.view(INCOMING), add_new=False)


@query("history_merge_parity", _parity_sql("e.PATID = n.PATID AND e.ADDRESS_ZIP5 = n.ADDRESS_ZIP5"))
def _(t: Inputs):
    return history.merge_history(t.view(EXISTING), t.view(INCOMING), parity=True)


@query(
    "later_and_earlier",
    f"SELECT ADDRESSID, {_later('a', 'b')} AS later, CASE WHEN b <= a THEN b ELSE a END AS earlier FROM (SELECT ADDRESSID, "
    f"ADDRESS_PERIOD_START AS a, CASE WHEN ADDRESS_ZIP5 LIKE '1%' THEN NULL ELSE '1998-06-15' END AS b FROM ({ADDRESSES.replace('{orders}', 'orders')} true))",
)
def _(t: Inputs):
    b = F.when(~F.coalesce(F.col("ADDRESS_ZIP5").startswith("1"), F.lit(False)), "1998-06-15")
    a = F.col("ADDRESS_PERIOD_START")
    return t.view(ADDRESSES + "true").select("ADDRESSID", dates.later_of(a, b).alias("later"), dates.earlier_of(a, b).alias("earlier"))


OLD = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'"
NEW = "SELECT o_orderkey, o_custkey, 'new' AS o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"


@query("upsert_keep_new", f"WITH o AS ({OLD}), n AS ({NEW}) SELECT * FROM n UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)")
def _(t: Inputs):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    old = t.orders.where("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'").select(*cols)
    new = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'").withColumn("o_orderstatus", F.lit("new")).select(*cols)
    return merge.upsert_keep_new(old, new, ["o_orderkey"])


@query(
    "missing_tables",
    "SELECT DISTINCT upper(p_name || p_brand) AS TABLE_NAME FROM part WHERE upper(p_name || p_brand) NOT IN "
    "(SELECT upper(p_name || p_brand) FROM part WHERE p_size < 10)",
)
def _(t: Inputs):
    named = t.part.withColumn("name", F.concat("p_name", "p_brand"))
    spec = named.select(F.upper("name").alias("TABLE_NAME"))
    return merge.missing_tables(spec, named.where("p_size < 10").select(F.col("name").alias("tableName")))


@query(
    "union_suite",
    "SELECT o_orderkey AS id, o_orderstatus AS kind, NULL::DOUBLE AS value FROM orders UNION ALL SELECT event_id, event_type, value FROM events",
)
def _(t: Inputs):
    orders = t.orders.selectExpr("o_orderstatus AS kind", "o_orderkey AS id")
    return merge.union_all([orders, t.events.selectExpr("event_id AS id", "event_type AS kind", "value")])


@query("positional_union", "SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def _(t: Inputs):
    return t.customer.selectExpr("c_custkey AS key", "c_name AS name").union(t.supplier.select("s_suppkey", "s_name"))


@query("set_difference", "SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size < 25")
def _(t: Inputs):
    return t.lineitem.select("l_partkey").subtract(t.part.where("p_size < 25").select("p_partkey"))


# --- lookups -----------------------------------------------------------------------


@query(
    "star_lookup",
    "SELECT l_orderkey, l_linenumber, o_orderpriority AS priority, c_mktsegment AS segment, p_brand AS brand, s_name AS supplier "
    "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey "
    "LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey",
)
def _(t: Inputs):
    df = lookup.lookup(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, {"priority": "o_orderpriority", "cust": "o_custkey"})
    df = lookup.lookup(df, t.customer, {"cust": "c_custkey"}, {"segment": "c_mktsegment"})
    df = lookup.lookup(df, t.part, {"l_partkey": "p_partkey"}, {"brand": "p_brand"})
    df = lookup.lookup(df, t.supplier, {"l_suppkey": "s_suppkey"}, {"supplier": "s_name"})
    return df.select("l_orderkey", "l_linenumber", "priority", "segment", "brand", "supplier")


@query(
    "snowflake_lookup",
    "SELECT c_custkey, n_name AS nation, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey",
)
def _(t: Inputs):
    df = lookup.lookup(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, {"nation": "n_name", "region_key": "n_regionkey"})
    return lookup.lookup(df, t.region, {"region_key": "r_regionkey"}, {"region": "r_name"}).select("c_custkey", "nation", "region")


@query(
    "concept_restrict",
    "SELECT l_orderkey, l_linenumber, p_name AS concept_name FROM lineitem JOIN part ON l_partkey = p_partkey "
    "WHERE regexp_matches(p_name, 'ring', 'i') AND p_type = 'LARGE'",
)
def _(t: Inputs):
    rows = F.col("p_name").rlike("(?i)RING") & (F.col("p_type") == "LARGE")
    return lookup.lookup(
        t.lineitem, t.part.where(rows), {"l_partkey": "p_partkey"}, {"concept_name": "p_name"}, how="inner"
    ).select("l_orderkey", "l_linenumber", "concept_name")


@query("concept_role", "SELECT p_partkey AS drug_concept_id, p_name AS drug_name FROM part WHERE p_type = 'PROMO'")
def _(t: Inputs):
    concept = t.part.selectExpr("p_partkey AS concept_id", "p_name AS concept_name", "p_type AS domain_id")
    return reference.concepts(concept, "drug", "domain_id = 'PROMO'", {"drug_name": "concept_name"})


@query(
    "id_remap",
    "SELECT o_orderkey, c_name AS o_custkey, o_orderstatus FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS k, o_orderstatus "
    "FROM orders) JOIN customer ON k = CAST(c_custkey AS VARCHAR) WHERE c_acctbal >= 0",
)
def _(t: Inputs):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus")
    id_map = _customers(t).select(F.col("c_custkey").cast("string").alias("ENCRYPTED_PATID"), F.col("c_name").alias("NEW_ID"))
    return lookup.remap_ids(orders, id_map, "o_custkey", "ENCRYPTED_PATID", "NEW_ID")


TRACTS = (
    "SELECT n_name || ' County' AS CountyName20, CAST(12000 + n_nationkey AS STRING) AS CountyFIPS20, CAST(n_regionkey AS STRING) "
    "AS StateFIPS20, r_name || ', ' || substr(r_name, 1, 2) AS UrbanAreaName20 FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"
)
ZIPS = (
    "SELECT CAST(n_nationkey * 111 AS STRING) AS ZIPCode, substr(r_name, 1, 2) AS State, CAST(n_nationkey % 10 AS STRING) AS PrimaryRUCA "
    "FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"
)
PLACES = (
    "SELECT c_custkey, lpad(CAST(c_nationkey * 111 + c_custkey % 2 AS STRING), 5, '0') AS zip, lower('nation_' || CAST(c_nationkey AS STRING)) "
    "AS county FROM {customer}"
)


def _duck(sql: str) -> str:
    return sql.replace("{", "").replace("}", "")


@query(
    "geo_lookup",
    f"WITH tr AS (SELECT DISTINCT * FROM ({_duck(TRACTS)})), zi AS ({_duck(ZIPS)}) SELECT c_custkey, zip, county, coalesce((SELECT max(PrimaryRUCA) FROM zi "
    "WHERE lpad(ZIPCode, 5, '0') = zip), '') AS RUCA_ZIP, (SELECT max(CountyFIPS20) FROM tr WHERE upper(replace(CountyName20, ' County', '')) "
    "= upper(county)) AS COUNTY_FIPS, (SELECT max(StateFIPS20) FROM zi JOIN tr ON right(UrbanAreaName20, 2) = State WHERE lpad(ZIPCode, 5, '0') = zip) "
    f"AS STATE_FIPS FROM ({_duck(PLACES)})",
)
def _(t: Inputs):
    tracts, zips = t.view(TRACTS), t.view(ZIPS)
    df = lookup.zip_to_ruca(t.view(PLACES), zips, "zip")
    df = lookup.county_to_fips(df, tracts, "county")
    return lookup.zip_to_state_fips(df, zips, tracts, "zip")


@query(
    "collapse_first_nonempty",
    "SELECT user_id, day, "
    + ", ".join(
        f"first({k} ORDER BY ts, event_id) FILTER (WHERE {k} <> '') AS {k}, first(v_{k} ORDER BY ts, event_id) FILTER (WHERE v_{k} IS NOT NULL) AS v_{k}"
        for k in ("click", "view")
    )
    + " FROM (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, ts, event_id, CASE event_type WHEN 'click' THEN props WHEN 'error' THEN '' END AS click, "
    "CASE event_type WHEN 'view' THEN props WHEN 'error' THEN '' END AS view, CASE event_type WHEN 'click' THEN value END AS v_click, "
    "CASE event_type WHEN 'view' THEN value END AS v_view FROM events) GROUP BY user_id, day",
)
def _(t: Inputs):
    kind = F.col("event_type")
    day = F.col("ts").cast("date").cast("string").alias("day")
    texts = [F.when(kind == k, F.col("props")).when(kind == "error", "").alias(k) for k in ("click", "view")]
    values = [F.when(kind == k, F.col("value")).alias(f"v_{k}") for k in ("click", "view")]
    wide = t.events.select("user_id", day, "ts", "event_id", *texts, *values)
    return collapse_first(wide, ["user_id", "day"], ["ts", "event_id"]).drop("ts", "event_id")


# --- projections, schema -----------------------------------------------------------


@query(
    "projection_passthrough",
    "SELECT CAST(o_orderkey AS VARCHAR) AS ENCOUNTERID, o_orderstatus AS ENC_TYPE, 'OD' AS ORIGIN, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def _(t: Inputs):
    spec = {"ENCOUNTERID": F.col("o_orderkey").cast("string"), "ENC_TYPE": F.col("o_orderstatus"), "ORIGIN": F.lit("OD")}
    return project.project(t.orders, spec, passthrough=True, used=["o_orderkey", "o_orderstatus", "o_custkey"])


@query("constants_audit", "SELECT *, '2024-01-01 00:00:00' AS UPDATED, 'ABC' AS SOURCE FROM customer")
def _(t: Inputs):
    return project.add_audit(t.customer, "abc", "2024-01-01 00:00:00")


@query("column_selection", "SELECT c_name, c_nationkey, c_custkey FROM customer")
def _(t: Inputs):
    wanted = t.customer.select("c_name", "c_nationkey", "c_custkey")
    slim = project.without_columns(t.customer, t.customer.select("c_acctbal", "c_custkey"), keep=["c_custkey"])
    return project.in_order_of(project.common_columns(slim, wanted), wanted)


@query("void_columns", "SELECT c_custkey, NULL::VARCHAR AS nothing FROM customer")
def _(t: Inputs):
    return project.void_to_string(t.customer.select("c_custkey", F.lit(None).alias("nothing")))


PART_SPEC = [
    ("P_PARTKEY", "RDBMS Number(x)"), ("P_NAME", "RDBMS Text(30)"), ("P_BRAND", "RDBMS Text(x)"), ("RAW_TYPE", "RDBMS Text(x)"),
    ("P_DATE", "RDBMS Date"), ("PATID", "RDBMS Text(x)"),
]
PART_TEXT = (
    "SELECT CAST(p_partkey AS STRING) AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, p_type AS RAW_TYPE, CASE WHEN p_size > 25 THEN 'bad' "
    "ELSE '2024-01-' || lpad(CAST(p_size AS STRING), 2, '0') END AS P_DATE, p_name || p_brand AS PATID, CAST(p_size AS STRING) AS EXTRA FROM {part}"
)


_SCHEMA_SQL = (
    "SELECT unnest(['P_PARTKEY', 'P_NAME', 'P_BRAND', 'RAW_TYPE', 'P_DATE', 'PATID', 'EXTRA', 'UPDATED', 'SOURCE']) AS field, unnest(['FLOAT', "
    "'VARCHAR(' || greatest(30, max(length(P_NAME))) || ')', 'VARCHAR(' || max(length(P_BRAND)) || ')', 'VARCHAR(' || max(length(RAW_TYPE)) || ')', 'DATE', "
    "'VARCHAR(' || greatest(64, max(length(PATID))) || ')', 'VARCHAR(' || max(length(EXTRA)) || ')', 'VARCHAR(19)', 'VARCHAR(20)']) AS sql_type "
    f"FROM ({_duck(PART_TEXT)})"
)


@query("spec_schema", _SCHEMA_SQL)
def _(t: Inputs):
    df = t.view(PART_TEXT)
    typed = schema.table_schema(PART_SPEC, schema.observed_widths(df))
    return t.spark.createDataFrame([(f.name, schema.sql_type(f)) for f in typed], "field STRING, sql_type STRING")


@query("ddl_render", f"SELECT string_agg(field || ' ' || sql_type, ',' || chr(10)) AS ddl FROM ({_SCHEMA_SQL})")
def _(t: Inputs):
    """One line of text per column of the table, whatever its rows."""
    typed = schema.table_schema(PART_SPEC, schema.observed_widths(t.view(PART_TEXT)))
    return t.spark.createDataFrame([(schema.ddl(typed),)], "ddl STRING")


@query(
    "typed_cast",
    "SELECT TRY_CAST(P_PARTKEY AS DOUBLE) AS P_PARTKEY, P_NAME, P_BRAND, RAW_TYPE, CAST(TRY_CAST(P_DATE AS DATE) AS VARCHAR) AS P_DATE, PATID, EXTRA, "
    f"NULL::VARCHAR AS UPDATED, NULL::VARCHAR AS SOURCE FROM ({_duck(PART_TEXT)})",
)
def _(t: Inputs):
    df = t.view(PART_TEXT)
    typed = schema.apply_schema(df, schema.table_schema(PART_SPEC, schema.observed_widths(df)))
    return typed.withColumn("P_DATE", F.col("P_DATE").cast("string"))


@query(
    "fix_chain",
    "SELECT * REPLACE (p.o_orderdate AS l_shipdate) FROM (SELECT * REPLACE (CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders WHERE "
    "o_orderstatus = 'O') THEN l_orderkey END AS l_orderkey) FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)) "
    "LEFT JOIN (SELECT o_orderkey AS k, o_orderdate FROM orders) p ON l_orderkey = p.k".replace("SELECT * REPLACE (p.o", "SELECT * EXCLUDE (k, o_orderdate) REPLACE (p.o"),
)
def _(t: Inputs):
    chains.register_fix("line_supplier", lambda df, at: orphans.drop_orphans(df, at.tables["S"], "l_suppkey", "s_suppkey"))
    chains.register_fix("line_order", lambda df, at: orphans.nullify_orphans(df, at.tables["O"], "l_orderkey", "o_orderkey"))
    chains.register_fix("line_date", lambda df, at: orphans.replicate(df, at.tables["D"], "l_orderkey", ["l_shipdate"]))
    dated = t.orders.selectExpr("o_orderkey AS l_orderkey", "o_orderdate AS l_shipdate")
    at = chains.Context({"S": t.supplier.where("s_acctbal >= 0"), "O": _open_orders(t), "D": dated})
    steps = [chains.step("line_supplier"), chains.step("line_order"), chains.step("line_date")]
    return chains.run_chain(t.lineitem, steps, at)[0]


# --- scalar functions over rendered text -------------------------------------------

STAMPS = (
    "SELECT event_id, CASE event_type WHEN 'click' THEN CAST(CAST(ts AS DATE) AS STRING) WHEN 'view' THEN substr(CAST(CAST(ts AS DATE) AS STRING), 6, 2) || '/' "
    "|| substr(CAST(CAST(ts AS DATE) AS STRING), 9, 2) || '/' || substr(CAST(CAST(ts AS DATE) AS STRING), 1, 4) WHEN 'error' THEN 'bad' WHEN 'signup' THEN NULL "
    "ELSE substr(CAST(ts AS STRING), 1, 19) END AS c, CASE WHEN event_type = 'view' THEN '' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS d FROM {events}"
)
NUMBERS = (
    "SELECT event_id, CASE event_type WHEN 'click' THEN '+' || CAST(CAST(floor(value) AS BIGINT) AS STRING) WHEN 'view' THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) || '/80' "
    "WHEN 'error' THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) || ' tablets' WHEN 'signup' THEN '1,' || lpad(CAST(CAST(floor(value) AS BIGINT) AS STRING), 3, '0') || '.5' "
    "ELSE CASE WHEN value < 2 THEN 'nan' WHEN value < 4 THEN '1_0' WHEN value < 6 THEN '1d' WHEN value < 8 THEN '' WHEN value < 10 THEN NULL ELSE "
    "' ' || CAST(CAST(floor(value) AS BIGINT) AS STRING) || '.50 ' END END AS c FROM {events}"
)
WORDS = (
    "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN '12|' || p_name WHEN 'SMALL' THEN lpad(CAST(p_partkey AS STRING), 5, '0') WHEN 'LARGE' THEN "
    "lpad(CAST(p_partkey AS STRING), 5, '0') || '-1234' WHEN 'MEDIUM' THEN lpad(CAST(p_partkey AS STRING), 10, '9') WHEN 'ECONOMY' THEN NULL ELSE "
    "CASE WHEN p_size < 10 THEN 'fl' WHEN p_size < 20 THEN 'NULL' WHEN p_size < 30 THEN 'e10E' ELSE 'a' || chr(1) || 'b' END END AS c, "
    "CASE WHEN p_size > 25 THEN p_brand END AS d FROM {part}"
)
FLAG_TEXT = (
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Primary' WHEN '2-HIGH' THEN 'Secondary' WHEN '3-MEDIUM' THEN 'NONE' WHEN '4-NOT SPECIFIED' "
    "THEN '' ELSE CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN 'POSITIVE' ELSE ' POC *as needed*' END END AS c, "
    "CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey % 5 AS STRING) WHEN o_orderstatus = 'F' THEN '30000000|638666' ELSE NULL END AS d, "
    "CASE WHEN o_orderstatus = 'P' THEN '2007-09-30' WHEN o_orderstatus = 'F' THEN '2007-10-01' ELSE 'x' END AS e FROM {orders}"
)
BY_FUNCTION = {
    "date_functions": (
        STAMPS,
        "event_id",
        "format_date format_time date_of_datetime time_of_datetime time_by_position us_date date_or_default datetime_or_default first_date(c,d)",
    ),
    "number_functions": (
        NUMBERS,
        "event_id",
        "to_double keep_if_numeric to_double_without_commas leading_quantity strip_signs ratio_text non_ratio_number",
    ),
    "text_functions": (
        WORDS,
        "p_partkey",
        "null_word after_pipe first_eight strip_exponent_marks zip5 zip9 us_state npi_flag dash_join(c,d) without_controls",
    ),
    "clinical_functions": (
        FLAG_TEXT,
        "o_orderkey",
        "condition_status lab_location prn_flag principal_diagnosis present_on_admission result_qualifier other_or_no_information "
        "principal_procedure(d) discharge_disposition(d) drg_version(e) drg_label(e)",
    ),
}


def _calls(names: str) -> list[tuple[str, list[str]]]:
    calls = []
    for call in names.split():
        name, _, rest = call.partition("(")
        calls.append((name, rest.rstrip(")").split(",") if rest else ["c"]))
    return calls


def _scalar(name: str, view: str, key: str, names: str) -> None:
    columns = ", ".join(f"{job_sql.FUNCTIONS[f](*cs)} AS {f}" for f, cs in _calls(names))

    @query(name, f"SELECT {key}, {columns} FROM ({_duck(view)})")
    def run(t: Inputs):
        from careloom.functions import BY_NAME

        return t.view(view).select(key, *[BY_NAME[f](*[F.col(c) for c in cs]).alias(f) for f, cs in _calls(names)])


for _name, _spec in BY_FUNCTION.items():
    _scalar(_name, *_spec)


@query(
    "whole_or_decimal",
    "SELECT event_id, CASE event_type WHEN 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) WHEN 'view' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.5' END AS refills "
    "FROM events",
)
def _(t: Inputs):
    n = F.floor("value").cast("string")
    raw = F.when(F.col("event_type") == "click", n).when(F.col("event_type") == "view", F.concat(n, F.lit(".50"))).otherwise("none")
    return t.events.select("event_id", numbers.whole_or_decimal(raw).alias("refills"))


_D, _T = "CAST(CAST(ts AS DATE) AS STRING)", "substr(CAST(ts AS STRING), 12, 8)"
_Y, _M, _DD = f"substr({_D}, 1, 4)", f"substr({_D}, 6, 2)", f"substr({_D}, 9, 2)"
_MON = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST({_M} AS INT) * 3 - 2, 3)"
WRITTEN = [
    _D, f"{_D} || ' ' || {_T}", f"{_M} || '/' || {_DD} || '/' || {_Y}", f"{_M} || '/' || {_DD} || '/' || {_Y} || ' ' || substr({_T}, 1, 5)",
    f"{_M} || '/' || {_DD} || '/' || {_Y} || ' ' || {_T}", f"{_M} || '/' || {_DD} || '/' || {_Y} || ' 12:00:00 AM'", f"{_M} || '/' || {_DD} || '/' || {_Y} || ' 3:05 pm'",
    f"{_Y} || {_M} || {_DD}", f"{_Y} || {_M} || {_DD} || ' 103000'", f"{_Y} || '/' || {_M} || '/' || {_DD}", f"{_M} || '-' || {_DD} || '-' || {_Y}",
    f"{_M} || '/' || {_DD} || '/' || substr({_Y}, 3, 2)", f"{_M} || '/' || {_DD} || '/71'", f"{_DD} || ' ' || {_MON} || ' ' || {_Y}", f"{_DD} || '-' || {_MON} || '-' || {_Y}",
    f"{_DD} || upper({_MON}) || {_Y}", f"{_MON} || ' ' || {_DD} || ', ' || {_Y}", "'bad'", "'31/31/2020'", "'  '", "NULL",
]
LAYOUTS = f"SELECT event_id, CASE event_id % {len(WRITTEN)} {' '.join(f'WHEN {k} THEN {w}' for k, w in enumerate(WRITTEN))} END AS c FROM {{events}}"


@query(
    "date_layouts",
    f"SELECT event_id, {job_sql.FUNCTIONS['format_date']('c')} AS day, {job_sql.FUNCTIONS['format_time']('c')} AS clock FROM ({_duck(LAYOUTS)})",
)
def _(t: Inputs):
    c = F.col("c")
    return t.view(LAYOUTS).select("event_id", dates.format_date(c).alias("day"), dates.format_time(c).alias("clock"))


_HALF = f"CASE WHEN substr({_T}, 1, 2) < '12' THEN 'am' ELSE 'pm' END"
_CLOCK12 = f"CAST((CAST(substr({_T}, 1, 2) AS INT) + 11) % 12 + 1 AS STRING) || substr({_T}, 3, 3)"
_LONG = (
    f"CASE {_M} WHEN '01' THEN 'January' WHEN '02' THEN 'February' WHEN '03' THEN 'March' WHEN '04' THEN 'April' WHEN '05' THEN 'May' WHEN '06' THEN 'June' "
    f"WHEN '07' THEN 'July' WHEN '08' THEN 'August' WHEN '09' THEN 'September' WHEN '10' THEN 'October' WHEN '11' THEN 'November' ELSE 'December' END"
)
# what none of the shapes fits, with the whole time of day; 'th' stands for any ordinal
BY_PARTS = [
    f"{_D} || 'T' || {_T}", f"{_D} || 'T' || {_T} || '.250Z'", f"{_D} || 'T' || {_T} || '+02:00'", f"{_D} || ' ' || substr({_T}, 1, 5)",
    f"{_Y} || {_M} || {_DD} || 'T' || replace({_T}, ':', '')", f"{_Y} || '.' || {_M} || '.' || {_DD} || ' ' || {_T}", f"{_M} || '.' || {_DD} || '.' || {_Y} || ' ' || {_T}",
    f"{_LONG} || ' ' || {_DD} || ', ' || {_Y} || ' ' || {_CLOCK12} || ' ' || {_HALF}", f"{_DD} || ' ' || {_LONG} || ' ' || {_Y} || ' ' || {_T}",
    f"'Monday, ' || {_LONG} || ' ' || {_DD} || 'th, ' || {_Y} || ' at ' || {_CLOCK12} || {_HALF}", f"'Tue, ' || {_DD} || ' ' || {_MON} || ' ' || {_Y} || ' ' || {_T} || ' GMT'",
    f"'Wed ' || {_MON} || ' ' || {_DD} || ' ' || {_T} || ' ' || {_Y}", f"{_DD} || '/' || {_MON} || '/' || {_Y} || ' ' || {_T}", f"{_Y} || '-' || {_MON} || '-' || {_DD} || ' ' || {_T}",
    f"{_T} || ' ' || {_M} || '/' || {_DD} || '/' || {_Y}", f"{_M} || '/' || {_DD} || '/' || {_Y} || ', ' || {_CLOCK12} || upper({_HALF})",
]
PARTS = f"SELECT event_id, ts, CASE event_id % {len(BY_PARTS)} {' '.join(f'WHEN {k} THEN {w}' for k, w in enumerate(BY_PARTS))} END AS c FROM {{events}}"


@query("dates_by_parts", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M') AS clock FROM events")
def _(t: Inputs):
    c = F.col("c")
    return t.view(PARTS).select("event_id", dates.format_date(c).alias("day"), dates.format_time(c).alias("clock"))


@query(
    "unreadable_dates",
    f"SELECT 'c' AS field, count(*) AS unreadable FROM ({_duck(LAYOUTS)}) WHERE trim(c) <> '' AND {job_sql.FUNCTIONS['format_date']('c')} IS NULL",
)
def _(t: Inputs):
    return profile.unreadable_dates(t.view(LAYOUTS), ["c"])


@query("month_bucket", "SELECT event_id, strftime(try_strptime(c, ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%d %H:%M:%S']), '%Y-%m') AS month FROM (" + _duck(STAMPS) + ")")
def _(t: Inputs):
    return t.view(STAMPS).select("event_id", dates.month_bucket(F.col("c")).alias("month"))


CLAIMS = (
    "SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'N' THEN 'u' WHEN 'A' THEN ' H' ELSE 'X' END AS form, "
    "CASE CAST(l_suppkey AS BIGINT) % 5 WHEN 0 THEN '0111' WHEN 1 THEN '210' WHEN 2 THEN '013' WHEN 3 THEN '' ELSE '999' END AS bill, "
    "CASE l_linenumber WHEN 1 THEN '0450' WHEN 2 THEN '0981' WHEN 3 THEN '0760' ELSE NULL END AS revenue, "
    "CASE CAST(l_partkey AS BIGINT) % 9 WHEN 0 THEN '99283' WHEN 1 THEN '99252' WHEN 2 THEN 'g0378' WHEN 3 THEN '99213' WHEN 4 THEN 'T1015' WHEN 5 THEN '' "
    "WHEN 6 THEN NULL ELSE 'J1234' END AS hcpcs, CASE CAST(l_orderkey AS BIGINT) % 7 WHEN 0 THEN '21' WHEN 1 THEN '02' WHEN 2 THEN '11' WHEN 3 THEN '99' WHEN 4 THEN '' "
    "WHEN 5 THEN 'zz' ELSE NULL END AS place, CASE WHEN l_linestatus = 'O' AND l_linenumber = 5 THEN 'gt' END AS mod1, CASE WHEN l_linenumber = 6 THEN '95' END AS mod4 FROM {lineitem}"
)


def _claim_sql() -> str:
    c = clinical

    def clean(name: str) -> str:
        return f"upper(trim(coalesce({name}, '')))"

    def among(name: str, values) -> str:
        return f"{clean(name)} IN ({', '.join(repr(v) for v in values)})"

    def starts(name: str, values) -> str:
        return f"regexp_matches({clean(name)}, '^(?:{'|'.join(values)})')"

    def between(bounds) -> str:
        digits = "regexp_replace(coalesce(trim(hcpcs), ''), '[^0-9]', '', 'g')"
        return f"(regexp_matches({digits}, '^[0-9]+$') AND TRY_CAST({digits} AS BIGINT) BETWEEN {bounds[0]} AND {bounds[1]})"

    def billed(values) -> str:
        return starts("bill", [*values, *["0" + v for v in values]])

    care = between(c.HCPCS_EMERGENCY_RANGE)
    emergency = f"({starts('revenue', c.REVENUE_EMERGENCY)} OR {care})"
    remote = f"({among('place', c.PLACE_TELEHEALTH)} OR {among('mod1', c.MODIFIER_TELEHEALTH)} OR {among('mod4', c.MODIFIER_TELEHEALTH)})"
    u, h = among("form", ["U"]), among("form", ["H"])
    rules = [
        (f"{u} AND {billed(c.BILL_INPATIENT)} AND {emergency}", "EI"),
        (f"{u} AND {billed(c.BILL_INPATIENT)}", "IP"),
        (f"{u} AND {billed(c.BILL_INSTITUTIONAL_STAY)}", "IS"),
        (f"{u} AND {emergency}", "ED"),
        (f"{u} AND ({among('revenue', c.REVENUE_OBSERVATION)} OR {among('hcpcs', c.HCPCS_OBSERVATION)})", "OS"),
        (f"{u} AND {billed(c.BILL_AMBULATORY)}", "AV"),
        (f"{u} AND {remote}", "TH"),
        (f"{u} AND length({clean('bill')}) > 0", "OT"),
        (f"{h} AND {care}", "ED"),
        (f"{h} AND ({among('place', c.PLACE_FACILITY_CONSULT)} OR {between(c.HCPCS_CONSULT_RANGE)})", "IC"),
        (f"{h} AND {among('hcpcs', c.HCPCS_OBSERVATION)}", "OS"),
        (f"{h} AND {remote}", "TH"),
        (f"{h} AND ({among('place', c.PLACE_AMBULATORY)} OR {among('hcpcs', c.HCPCS_VISIT)})", "AV"),
        (f"{h} AND {among('place', c.PLACE_OTHER)}", "OT"),
        (h, "AV"),
    ]
    cases = " ".join(f"WHEN {test} THEN '{code}'" for test, code in rules)
    return f"SELECT l_orderkey, l_linenumber, CASE {cases} ELSE 'NI' END AS enc_type FROM ({_duck(CLAIMS)})"


@query("encounter_type", _claim_sql())
def _(t: Inputs):
    typed = claims.add_encounter_type(t.view(CLAIMS), "form", "bill", "revenue", "hcpcs", "place", ["mod1", "mod4"], name="enc_type")
    return typed.select("l_orderkey", "l_linenumber", "enc_type")


# --- pseudonyms --------------------------------------------------------------------


def _keyed(site: str, c: str, salt: str = "") -> str:
    return job_sql.keyed("key", site, c, salt)


@query(
    "pseudonymise_keyed",
    f"SELECT c_custkey, {_keyed('A', 'c_name')} AS short_site, {_keyed('ABC', 'c_name')} AS id, {_keyed('ABC', 'c_name', 'OBS_GEN')} AS salted, "
    f"{_keyed('A', 'concat(chr(66), chr(67), c_name)')} AS run_on FROM customer",
)
def _(t: Inputs):
    c = F.col("c_name")
    return t.customer.select(
        "c_custkey", ids.pseudonym(c, "A", "key").alias("short_site"), ids.pseudonym(c, "ABC", "key").alias("id"),
        ids.pseudonym(c, "ABC", "key", salt="OBS_GEN").alias("salted"), ids.pseudonym(F.concat(F.lit("BC"), c), "A", "key").alias("run_on"),
    )


_PAD = "[" + ", ".join(str(b) for b in __import__("hashlib").sha1(b"seed").digest()) + "]"
_BYTE = "((instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)"


@query(
    "pseudonymise_xor",
    f"SELECT c_custkey, base64(unhex(array_to_string(list_transform(range(0, length(h) // 2), lambda i: printf('%02X', xor({_BYTE}::BIGINT, "
    f"{_PAD}[i % 20 + 1]::BIGINT))), ''))) AS id FROM (SELECT c_custkey, hex(encode('ABC' || c_name)) AS h FROM customer)",
)
def _(t: Inputs):
    return t.customer.select("c_custkey", ids.pseudonym(F.col("c_name"), "ABC", "seed", "xor").alias("id"))


def _delivered(t: Inputs):
    """Orders as a partner's tab-separated files, some lines of which lack a field or have one too many."""
    short, long_ = F.col("o_orderkey") % 50 == 0, F.col("o_orderkey") % 50 == 1
    fields = [F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderpriority")]
    line = F.concat_ws("\t", *fields[:2], F.when(~short, fields[2]), F.when(long_, F.lit("more")))
    folder = f"{batch_folder(t.spark, 'delivered')}/{uuid.uuid4().hex}"
    # the header of the only column is that of the three fields
    t.orders.select(line.alias("ORDER\tCUSTOMER\tPRIORITY")).write.options(header=True, sep="\x01", quote="").csv(folder)
    checked = files.read_checked(t.spark, folder)

    def settle(df):
        write_stage(df, f"{folder}-checked", by=TOUCHED)
        return files.read_stage(t.spark, f"{folder}-checked", df.schema)

    return checked.settle(settle)


ORDER_LINE = """SELECT o_orderkey % 50 AS fault, CAST(o_orderkey AS VARCHAR) AS "ORDER", CAST(o_custkey AS VARCHAR) AS CUSTOMER, o_orderpriority AS PRIORITY FROM orders"""


@query("checked_lines", f"SELECT * EXCLUDE (fault) FROM ({ORDER_LINE}) WHERE fault NOT IN (0, 1)")
def _(t: Inputs):
    return _delivered(t).good


@query(
    "checked_lines_rejects",
    "SELECT \"ORDER\", CUSTOMER, CASE WHEN fault = 1 THEN PRIORITY END AS PRIORITY, "
    "concat_ws(chr(9), \"ORDER\", CUSTOMER, CASE WHEN fault = 1 THEN PRIORITY || chr(9) || 'more' END) AS record "
    f"FROM ({ORDER_LINE}) WHERE fault IN (0, 1)",
)
def _(t: Inputs):
    return _delivered(t).rejects.drop("file")
