"""Registered queries: cleaning, casting, shapes, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clean as C
from tidemark.functions.types import ColumnSpec
from tidemark.operators import infer as I
from tidemark.operators import json_shape as J
from tidemark.operators import shape as S
from tidemark.operators import sketches as K
from tidemark.operators.keys import dedupe
from tidemark.plans.registry import Tables, query
from tidemark.session import work_dir

TOKENS = "('', ' ', 'nan', 'None', 'NULL', 'null')"


def null_sql(c: str) -> str:
    return f"CASE WHEN {c} NOT IN {TOKENS} THEN {c} END"


def trimmed_sql(c: str) -> str:
    return f"CASE WHEN trim({c}) NOT IN {TOKENS} THEN trim({c}) END"


def int_sql(c: str, unparsable: str) -> str:
    t = f"({trimmed_sql(c)})"
    cut = f"CAST(CAST(trunc(TRY_CAST({t} AS DOUBLE)) AS BIGINT) AS VARCHAR)"
    return f"CASE WHEN contains({t}, '.') THEN coalesce({cut}, {unparsable}) ELSE {t} END"


def bool_sql(c: str) -> str:
    t = f"lower({trimmed_sql(c)})"
    return (
        f"CASE WHEN {t} IN ('true', '1', 'yes', 'on') THEN 'true' "
        f"WHEN {t} IN ('false', '0', 'no', 'off') THEN 'false' ELSE {t} END"
    )


def one_column(name: str, column: str, rule, sql: str) -> None:
    """Register a cleaning rule on one column of the dirty table."""

    @query(name, f"SELECT event_id, {column}, {sql} AS cleaned FROM dirty", uses=("dirty",))
    def run(t: Tables) -> DataFrame:
        return t.dirty.select("event_id", column, rule(F.col(column)).alias("cleaned"))


one_column("clean_integer", "raw_int", C.clean_int, int_sql("raw_int", trimmed_sql("raw_int")))
one_column("clean_integer_strict", "raw_int", C.clean_int_strict, int_sql("raw_int", "NULL"))
one_column(
    "clean_integer_exact",
    "raw_int",
    C.clean_int_exact,
    f"""CASE WHEN contains(raw_int, '.') AND TRY_CAST(raw_int AS DOUBLE) = floor(
                 TRY_CAST(raw_int AS DOUBLE)) THEN split_part(raw_int, '.', 1)
             ELSE {trimmed_sql("raw_int")} END""",
)
one_column(
    "clean_float",
    "raw_int",
    C.clean_float,
    f"TRY_CAST({null_sql('raw_int')} AS DOUBLE)",
)
one_column("clean_boolean", "raw_bool", C.clean_bool, bool_sql("raw_bool"))
one_column(
    "transform_integer_sql",
    "raw_int",
    C.integer_text,
    """CASE WHEN regexp_full_match(raw_int, '[0-9]+\\.[0]+')
            THEN CAST(CAST(CAST(raw_int AS DECIMAL(38, 4)) AS HUGEINT) AS VARCHAR)
            WHEN raw_int <> '' THEN raw_int END""",
)
one_column(
    "transform_text_sql",
    "raw_date",
    C.plain_text,
    """CASE WHEN regexp_full_match(raw_date, '(19|20)[0-9]{6}')
                 AND try_strptime(raw_date, '%Y%m%d') IS NOT NULL
            THEN strftime(try_strptime(raw_date, '%Y%m%d'), '%Y-%m-%d')
            WHEN regexp_full_match(raw_date, '[0-9]+')
            THEN CAST(CAST(raw_date AS HUGEINT) AS VARCHAR)
            WHEN raw_date <> '' THEN raw_date END""",
)
one_column(
    "transform_decimal_text",
    "raw_int",
    C.decimal_text,
    """CASE WHEN regexp_full_match(raw_int, '[0-9]+\\.[0-9]+')
            THEN CAST(CAST(round(CAST(raw_int AS DECIMAL(38, 4)), 0) AS HUGEINT) AS VARCHAR)
            ELSE raw_int END""",
)


@query(
    "clean_null_tokens",
    f"""SELECT event_id, {null_sql("raw_int")} AS raw_int, {null_sql("raw_bool")} AS raw_bool,
               {null_sql("raw_date")} AS raw_date, {null_sql("raw_text")} AS raw_text
        FROM dirty""",
    uses=("dirty",),
)
def clean_null_tokens(t: Tables) -> DataFrame:
    return S.clean_columns(t.dirty, ["raw_int", "raw_bool", "raw_date", "raw_text"], C.clean_null)


@query(
    "clean_priority",
    f"""SELECT event_id, {int_sql("raw_int", trimmed_sql("raw_int"))} AS priority, raw_text
        FROM dirty""",
    uses=("dirty",),
)
def clean_priority(t: Tables) -> DataFrame:
    """The integer rule bound to a named column."""
    rows = t.dirty.select("event_id", F.col("raw_int").alias("priority"), "raw_text")
    return S.clean_columns(rows, ["priority"], C.clean_int)


@query(
    "clean_datetime",
    f"""SELECT event_id, {null_sql("raw_date")} AS cleaned,
               CASE WHEN regexp_full_match(raw_date, '[0-9]{{8}}')
                    THEN CAST(try_strptime(raw_date, '%Y%m%d') AS DATE) END AS as_day
        FROM dirty""",
    uses=("dirty",),
)
def clean_datetime(t: Tables) -> DataFrame:
    raw = F.col("raw_date")
    return t.dirty.select(
        "event_id",
        C.clean_datetime(raw).alias("cleaned"),
        C.to_date(raw, "yyyyMMdd").alias("as_day"),
    )


DECLARED = [
    ColumnSpec("event_id", "bigint", nullable=False),
    ColumnSpec("raw_int", "bigint", nullable=False),
    ColumnSpec("raw_bool", "boolean"),
    ColumnSpec("raw_date", "date"),
    ColumnSpec("raw_text", "character varying", nullable=False, max_length=5),
]


@query(
    "clean_by_schema",
    f"""SELECT event_id, {int_sql("raw_int", trimmed_sql("raw_int"))} AS raw_int,
               {bool_sql("raw_bool")} AS raw_bool, {null_sql("raw_date")} AS raw_date,
               {null_sql("raw_text")} AS raw_text
        FROM dirty""",
    uses=("dirty",),
)
def clean_by_schema(t: Tables) -> DataFrame:
    return S.clean(t.dirty, DECLARED)


@query(
    "post_clean_check",
    f""", cleaned AS (
          SELECT {int_sql("raw_int", trimmed_sql("raw_int"))} AS raw_int, raw_bool, raw_date,
                 raw_text FROM dirty)
        SELECT 'raw_int' AS column_name, 'decimal_point' AS "check",
               count(*) FILTER (contains(raw_int, '.')) AS n FROM cleaned
        UNION ALL SELECT 'raw_int', 'blank', count(*) FILTER (trim(raw_int) = '') FROM cleaned
        UNION ALL SELECT 'raw_bool', 'blank', count(*) FILTER (trim(raw_bool) = '') FROM cleaned
        UNION ALL SELECT 'raw_date', 'blank', count(*) FILTER (trim(raw_date) = '') FROM cleaned
        UNION ALL SELECT 'raw_text', 'blank', count(*) FILTER (trim(raw_text) = '')
        FROM cleaned""",
    uses=("dirty",),
)
def post_clean_check(t: Tables) -> DataFrame:
    cleaned = S.clean_columns(t.dirty, ["raw_int"], C.clean_int)
    return S.post_clean_check(cleaned, ["raw_int"])


@query(
    "not_null_violations",
    f""", cleaned AS (
          SELECT event_id, {null_sql("raw_int")} AS raw_int, {null_sql("raw_bool")} AS raw_bool
          FROM dirty),
        ranked AS (
          SELECT 'raw_int' AS column_name, event_id,
                 row_number() OVER (ORDER BY event_id) AS r FROM cleaned WHERE raw_int IS NULL
          UNION ALL
          SELECT 'raw_bool', event_id, row_number() OVER (ORDER BY event_id)
          FROM cleaned WHERE raw_bool IS NULL)
        SELECT column_name, count(*) AS null_count,
               string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id)
                 FILTER (r <= 3) AS sample_ids
        FROM ranked GROUP BY column_name""",
    uses=("dirty",),
)
def not_null_violations(t: Tables) -> DataFrame:
    cleaned = S.clean_columns(
        t.dirty.select("event_id", "raw_int", "raw_bool"), ["raw_int", "raw_bool"], C.clean_null
    )
    report = S.not_null_violations(cleaned, ["event_id", "raw_int", "raw_bool"], ["event_id"])
    ids = F.transform("samples", lambda s: F.get_json_object(s, "$.event_id"))
    return report.select(
        "column_name",
        "null_count",
        F.array_join(ids, ",").alias("sample_ids"),
    )


@query(
    "dedupe_by_key",
    """SELECT * EXCLUDE (r) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
           l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
           l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
           l_linestatus DESC) AS r
         FROM lineitem) WHERE r = 1""",
)
def dedupe_by_key(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return dedupe(t.lineitem, ["l_orderkey", "l_linenumber"], order)


INT_CAST = "CASE WHEN regexp_full_match(trim(raw_int), '[0-9]+') THEN CAST(trim(raw_int) AS BIGINT) END"
BOOL_CAST = (
    "CASE WHEN lower(trim(raw_bool)) IN ('true', '1', 'yes') THEN true "
    "WHEN lower(trim(raw_bool)) IN ('false', '0', 'no') THEN false END"
)
DATE_CAST = (
    "CASE WHEN regexp_full_match(raw_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
    "THEN CAST(raw_date AS DATE) END"
)


@query(
    "cast_to_target",
    f"""SELECT event_id, {INT_CAST} AS raw_int, {BOOL_CAST} AS raw_bool,
               {DATE_CAST} AS raw_date,
               CASE WHEN length(raw_text) <= 5 THEN raw_text END AS raw_text
        FROM dirty""",
    uses=("dirty",),
)
def cast_to_target(t: Tables) -> DataFrame:
    return S.cast_to(t.dirty, DECLARED)


@query(
    "conform_to_target",
    f"""SELECT raw_text, event_id, {DATE_CAST} AS raw_date,
               TIMESTAMP '2025-08-12 01:00:00' AS loaded_at, true AS is_active,
               CAST(5 AS INTEGER) AS priority, 'it''s new' AS note,
               CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS owner
        FROM dirty""",
    uses=("dirty",),
)
def conform_to_target(t: Tables) -> DataFrame:
    shape = [
        ColumnSpec("raw_text", "text"),
        ColumnSpec("event_id", "bigint", nullable=False),
        ColumnSpec("raw_date", "date"),
        ColumnSpec("loaded_at", "timestamp without time zone", default="now()"),
        ColumnSpec("is_active", "boolean", default="true"),
        ColumnSpec("priority", "integer", default="5"),
        ColumnSpec("note", "text", default="'it''s new'"),
        ColumnSpec("seq", "bigint", default="nextval('seq')"),
        ColumnSpec("owner", "character varying", default="'x'::character varying"),
    ]
    return S.conform(t.dirty, shape, "2025-08-12 01:00:00")


@query(
    "create_all_text",
    """SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text
       FROM conversations""",
)
def create_all_text(t: Tables) -> DataFrame:
    return S.all_text(t.conversations)


@query(
    "align_columns",
    """SELECT o_orderdate, o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS changed,
              CAST(NULL AS BIGINT) AS source_version
       FROM orders_tgt""",
    uses=("orders_tgt",),
)
def align_columns(t: Tables) -> DataFrame:
    like = t.orders_ymd.select(
        "o_orderdate",
        "o_orderkey",
        "o_totalprice",
        "changed",
        F.col("version").alias("source_version"),
    )
    return S.align(t.orders_tgt, like.schema)


@query(
    "type_drift_report",
    f""", casts AS (
          SELECT *, {INT_CAST} AS i, {BOOL_CAST} AS b, {DATE_CAST} AS d FROM dirty)
        SELECT 'event_id' AS column_name, 'bigint' AS source_type, 'bigint' AS target_type,
               count(*) AS row_count, 0 AS cast_failures, 0 AS over_long,
               0 AS nulls_in_not_null FROM casts
        UNION ALL SELECT 'raw_int', 'string', 'bigint', count(*),
               count(*) FILTER (raw_int IS NOT NULL AND i IS NULL), 0,
               count(*) FILTER (raw_int IS NULL) FROM casts
        UNION ALL SELECT 'raw_bool', 'string', 'boolean', count(*),
               count(*) FILTER (raw_bool IS NOT NULL AND b IS NULL), 0, 0 FROM casts
        UNION ALL SELECT 'raw_date', 'string', 'date', count(*),
               count(*) FILTER (raw_date IS NOT NULL AND d IS NULL), 0, 0 FROM casts
        UNION ALL SELECT 'raw_text', 'string', 'string', count(*), 0,
               count(*) FILTER (length(raw_text) > 5),
               count(*) FILTER (raw_text IS NULL) FROM casts
        UNION ALL SELECT 'source_version', 'missing', 'bigint', count(*), 0, 0, 0
        FROM casts""",
    uses=("dirty",),
)
def type_drift_report(t: Tables) -> DataFrame:
    return S.drift_report(t.dirty, [*DECLARED, ColumnSpec("source_version", "bigint")])


def profile_sql(table: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count,
                   count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count,
                   CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value
            FROM {table}"""
        for c in columns
    )


ORDER_COLUMNS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
]


DIRTY_DATES = ["mixed", "american", "amount", "flag"]


def candidates_sql() -> str:
    """What every value fits, by looks and, for dates, by whether the day exists."""
    fits = [f"""CASE WHEN regexp_matches(v, '{p.replace("(?i:", "(").replace("^(", "^(?i)(") if name == "boolean" else p}')
            THEN '{name}' END""" for name, p in I.PLAIN.items()]
    signs = {"yyyy": "%Y", "MM": "%m", "dd": "%d", "HH": "%H", "mm": "%M", "ss": "%S", "'T'": "T"}
    for fmt, looks in {**I.DATES, **I.TIMES}.items():
        strf = fmt
        for a, b in signs.items():
            strf = strf.replace(a, b)
        years = f"AND year(try_strptime(v, '{strf}')) BETWEEN 1900 AND 2100" if fmt in ("yyyyMMdd", "yyyyMMddHHmmss") else ""
        quoted = fmt.replace("'", "''")
        fits.append(
            f"CASE WHEN regexp_matches(v, '{looks}') AND try_strptime(v, '{strf}') IS NOT NULL {years} THEN '{quoted}' END"
        )
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN trim({c}) NOT IN {TOKENS} THEN trim({c}) END AS v FROM dirty_dates"
        for c in DIRTY_DATES
    )
    return f""", cells AS ({cells}), fit AS (SELECT column_name, v, CASE WHEN v IS NOT NULL THEN
        array_to_string(list_filter([{", ".join(fits)}], lambda x: x IS NOT NULL), '|') END AS candidates FROM cells)"""


@query(
    "format_counts",
    f"""{candidates_sql()} SELECT column_name, candidates, count(*) AS n, min(v) AS example FROM fit GROUP BY 1, 2""",
    uses=("dirty_dates",),
)
def format_counts(t: Tables) -> DataFrame:
    found = I.format_counts(t.dirty_dates, DIRTY_DATES)
    return found.withColumn("candidates", F.array_join("candidates", "|"))


@query(
    "typed_by_inference",
    """SELECT event_id,
              CASE WHEN event_id % 8 NOT IN (5, 7) THEN CAST(strptime(d, '%Y%m%d') AS DATE) END AS mixed,
              CASE WHEN event_id % 5 <> 0 THEN CAST(strptime(d, '%Y%m%d') AS DATE) END AS american,
              CASE WHEN event_id % 4 = 0 THEN 1500 ELSE event_id END::DOUBLE AS amount, event_id % 3 <> 1 AS flag
       FROM dirty_dates""",
    uses=("dirty_dates",),
)
def typed_by_inference(t: Tables) -> DataFrame:
    """Mixed formats, a ninth part of them impossible days, read as the dates they were written from."""
    dirty = t.dirty_dates.drop("d")
    found = I.infer(I.format_counts(dirty, DIRTY_DATES), tolerance=0.2)
    return I.typed(dirty, found)


TREE_SQL = """, tree AS (
    SELECT o_orderkey, regexp_replace(t.fullkey, '\\[\\d+\\]', '[*]', 'g') AS path,
           CASE t.type WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
             WHEN 'DOUBLE' THEN 'decimal' ELSE lower(t.type) END AS kind
    FROM (SELECT * FROM orders_json WHERE json_valid(doc)) AS o, json_tree(o.doc) AS t
    UNION ALL
    SELECT o_orderkey, '$', CASE WHEN doc IS NULL THEN 'absent' ELSE 'invalid' END
    FROM orders_json WHERE doc IS NULL OR NOT json_valid(doc)),
  paths AS (SELECT path, kind, count(*) AS "values", count(DISTINCT o_orderkey) AS documents
    FROM tree GROUP BY ALL)"""


@query("json_paths", f"{TREE_SQL} SELECT * FROM paths", uses=("orders_json",))
def json_paths(t: Tables) -> DataFrame:
    return J.json_paths(t.orders_json, "doc")


DECLARED_JSON = {
    "$": "object", "$.id": "integer", "$.customer": "object", "$.customer.key": "integer",
    "$.customer.vip": "boolean", "$.tags": "array", "$.status": "string", "$.total": "decimal",
}


@query(
    "json_drift",
    f"""{TREE_SQL}, want AS (SELECT * FROM (VALUES {", ".join(f"('{p}', '{k}')" for p, k in DECLARED_JSON.items())})
          AS x(path, declared))
        SELECT path, declared,
               coalesce(sum("values") FILTER (declared IS NOT NULL AND kind IN (declared, 'null')), 0)::BIGINT AS fitting,
               coalesce(sum("values") FILTER (declared IS NULL OR kind NOT IN (declared, 'null')), 0)::BIGINT AS other
        FROM paths FULL JOIN want USING (path) GROUP BY ALL""",
    uses=("orders_json",),
)
def json_drift(t: Tables) -> DataFrame:
    return J.json_drift(J.json_paths(t.orders_json, "doc"), DECLARED_JSON).drop("found")


JSON_SHAPE = {
    "id": ("$.id", "bigint"), "customer": ("$.customer.key", "bigint"), "vip": ("$.customer.vip", "boolean"),
    "status": ("$.status", "string"),
}


@query(
    "json_columns",
    """SELECT o_orderkey, TRY_CAST(d->>'$.id' AS BIGINT) AS id, TRY_CAST(d->>'$.customer.key' AS BIGINT) AS customer,
              TRY_CAST(d->>'$.customer.vip' AS BOOLEAN) AS vip, d->>'$.status' AS status
       FROM (SELECT o_orderkey, CASE WHEN json_valid(doc) THEN doc END AS d FROM orders_json)""",
    uses=("orders_json",),
)
def json_columns(t: Tables) -> DataFrame:
    return J.json_columns(t.orders_json, "doc", JSON_SHAPE).drop("doc")


def profiles_by_year(t: Tables) -> K.ProfileStore:
    """Every year of orders as a load, profiled on its own."""
    orders = t.orders
    store = K.ProfileStore(t.spark, work_dir(t.spark, "profiles"), orders.schema)
    for r in orders.select(F.year("o_orderdate").alias("y")).distinct().collect():
        store.add(str(r["y"]), orders.where(F.year("o_orderdate").eqNullSafe(F.lit(r["y"]))))
    return store


@query(
    "profile_by_loads",
    f"""SELECT * EXCLUDE (distinct_count) FROM ({profile_sql("orders", ORDER_COLUMNS)})""",
)
def profile_by_loads(t: Tables) -> DataFrame:
    """What is exact in a profile merged from those of the loads."""
    return profiles_by_year(t).report().select(
        "column_name", "row_count", "null_count", "min_value", "max_value"
    )


@query(
    "profile_frequent",
    """SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 2
       UNION ALL
       SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def profile_frequent(t: Tables) -> DataFrame:
    """Fewer values than the sketch tracks are counted exactly."""
    found = profiles_by_year(t).report().where("column_name IN ('o_orderstatus', 'o_orderpriority')")
    return found.select("column_name", F.inline("frequent")).withColumnRenamed("count", "n")


@query(
    "profile_error_bounds",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, true AS distinct_in_bounds, {q} AS median_in_bounds"
        for c, q in zip(ORDER_COLUMNS, ["true", "true", "NULL::BOOLEAN", "true", "true", "NULL::BOOLEAN"], strict=True)
    ),
)
def profile_error_bounds(t: Tables) -> DataFrame:
    """Estimates from merged sketches against exact counts and exact ranks."""
    orders = t.orders
    sketch = profiles_by_year(t).report().select(
        "column_name", "distinct_count", F.col("quantiles")[1].alias("median")
    )
    exact = S.profile(orders, exact=True).select("column_name", F.col("distinct_count").alias("exact"))
    # Share of values up to the estimated median, and below it: the median's rank lies between.
    medians = {r["column_name"]: r["median"] for r in sketch.collect() if r["median"] is not None}
    ranks = orders.agg(
        *(
            F.struct(
                F.avg((F.col(c) < F.lit(m).cast(orders.schema[c].dataType)).cast("int")).alias("low"),
                F.avg((F.col(c) <= F.lit(m).cast(orders.schema[c].dataType)).cast("int")).alias("high"),
            ).alias(c)
            for c, m in medians.items()
        )
    ).select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("r")) for c in medians])))
    return (
        sketch.join(exact, "column_name").join(ranks, "column_name", "left")
        .select(
            "column_name",
            (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact")).alias("distinct_in_bounds"),
            ((F.col("r.low") <= 0.53) & (F.col("r.high") >= 0.47)).alias("median_in_bounds"),
        )
    )


@query(
    "profile_value_drift",
    """, old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
       SELECT 'o_orderstatus' AS column_name, (SELECT count(*) FROM (
                SELECT o_orderstatus FROM new EXCEPT SELECT o_orderstatus FROM old)) AS new_values
       UNION ALL SELECT 'o_orderdate', (SELECT count(*) FROM (
                SELECT o_orderdate FROM new EXCEPT SELECT o_orderdate FROM old))
       UNION ALL SELECT 'o_orderpriority', (SELECT count(*) FROM (
                SELECT o_orderpriority FROM new EXCEPT SELECT o_orderpriority FROM old))""".replace(
        ", old AS", "WITH old AS", 1
    ),
)
def profile_value_drift(t: Tables) -> DataFrame:
    """Values of later years that earlier ones lack, from the stored sketches alone."""
    store = profiles_by_year(t)
    years = [str(y) for y in range(1990, 2010)]
    before, after = store.profile(years[:8]), store.profile(years[8:])
    return K.value_drift(before, after, store.schema).where(
        "column_name IN ('o_orderstatus', 'o_orderdate', 'o_orderpriority')"
    ).select("column_name", "new_values")


@query("column_profile", profile_sql("orders", ORDER_COLUMNS))
def column_profile(t: Tables) -> DataFrame:
    return S.profile(t.orders, exact=True)
