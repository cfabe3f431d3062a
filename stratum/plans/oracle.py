"""The registered queries once more, as SQL for an independent engine.

Each text starts from the given tables.  Merges are written the way the statement sequence
reads, with joins between pending and silver rows, and share no method with the DataFrame
merge: no value ranges, no salts, no slices.
"""

from __future__ import annotations

from stratum.plans.given import UNSOUND
from stratum.specs import HISTORY_ENTITIES, SPECS, MergeSpec

_TAIL = "valid_from, valid_to, active, load_timestamp, source_date"
_B = "CROSS JOIN (SELECT 1 AS b UNION ALL SELECT 2 AS b) two"
_DAILY = """CASE WHEN b = 2 THEN TIMESTAMP '2024-05-07 00:00:00' ELSE TIMESTAMP '2024-05-06 00:00:00' END AS inserted_at,
  b AS batch_value, CASE WHEN b = 2 THEN DATE '2024-05-07' ELSE DATE '2024-05-06' END AS origin_date, 0 AS merge_status"""


def _day0(active: str) -> str:
    return f"""TIMESTAMP '2024-05-05 00:00:00' AS valid_from,
  CASE WHEN NOT ({active}) THEN TIMESTAMP '2024-05-05 12:00:00' END AS valid_to, ({active}) AS active,
  TIMESTAMP '2024-05-05 00:00:00' AS load_timestamp, DATE '2024-05-05' AS source_date"""


_CUSTOMER = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_SUPPLIER = "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_INGREDIENT = """s_suppkey AS ingredient_id, s_name AS name, concat('F', CAST(s_nationkey AS VARCHAR)) AS chemical_formula,
  CAST(s_nationkey + 10 AS DOUBLE) AS molecular_weight, {cost} AS cost_per_gram, CAST(s_nationkey AS BIGINT) AS provider_id"""
_SALE = """l_orderkey * 8 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS flavour_id,
  l_quantity AS quantity_liters, CAST(o_orderdate AS DATE) AS transaction_date, l_linestatus AS country, l_returnflag AS town,
  concat(l_returnflag, l_linestatus) AS postal_code, {amount} AS amount_dollar"""

# Derived tables in order of need: name -> query.
TABLES: dict[str, str] = {
    "numbered_lines": """SELECT *, (l_orderkey * 8 + l_linenumber) * 100 + line_repeat AS line_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS line_repeat FROM lineitem) r""",
    "customers_silver": f"""SELECT c_custkey AS customer_id, c_name AS name, n_name AS city, r_name AS country,
  {_day0("c_acctbal >= 0")} FROM {_CUSTOMER}""",
    "customers_staging": f"""SELECT c_custkey * 10 + b AS row_id,
  CASE WHEN c_mktsegment = 'FURNITURE' AND c_acctbal > 9000 THEN -1 - c_custkey
    WHEN c_mktsegment = 'HOUSEHOLD' AND c_acctbal > 9500 THEN NULL ELSE c_custkey END AS customer_id,
  CASE WHEN c_mktsegment = 'BUILDING' OR (c_mktsegment = 'AUTOMOBILE' AND b = 2)
    THEN concat(c_name, '_v', CAST(b AS VARCHAR)) ELSE c_name END AS name,
  CASE WHEN c_mktsegment = 'MACHINERY' AND b = 1 THEN NULL ELSE n_name END AS location_city, r_name AS location_country,
  {_DAILY} FROM {_CUSTOMER} {_B}""",
    "provider_silver": f"""SELECT s_suppkey AS provider_id, s_name AS name, n_name AS city, r_name AS country,
  {_day0("s_acctbal >= 0")} FROM {_SUPPLIER}""",
    "provider_staging": f"""SELECT s_suppkey * 10 + b AS row_id, s_suppkey AS provider_id, s_name AS name,
  CASE WHEN r_name = 'ASIA' THEN concat(n_name, '_v', CAST(b AS VARCHAR)) ELSE n_name END AS location_city,
  r_name AS location_country, {_DAILY} FROM {_SUPPLIER} {_B}""",
    "flavours_silver": f"""SELECT p_partkey AS flavour_id, p_name AS name, p_type AS description,
  {_day0("p_size > 5")} FROM part""",
    "flavours_staging": f"""SELECT p_partkey * 10 + b AS row_id, p_partkey AS flavour_id, p_name AS name,
  CASE WHEN p_type = 'PROMO' OR (p_type = 'LARGE' AND b = 2) THEN concat(p_type, '_v', CAST(b AS VARCHAR))
    ELSE p_type END AS description, {_DAILY} FROM part {_B}""",
    "rawmaterialtype_silver": f"""SELECT p_partkey AS raw_material_type_id, concat(p_brand, ' ', p_type) AS name,
  {_day0("p_retailprice >= 910")} FROM part""",
    "rawmaterialtype_staging": f"""SELECT p_partkey * 10 + b AS row_id, p_partkey AS raw_material_type_id,
  CASE WHEN p_type = 'SMALL' THEN concat(p_brand, ' ', p_type, '_v', CAST(b AS VARCHAR))
    ELSE concat(p_brand, ' ', p_type) END AS name, {_DAILY} FROM part {_B}""",
    "ingredientsrawmaterial_silver": f"""SELECT o_orderkey AS ingredient_rawmaterial_id, o_custkey AS ingredient_id,
  CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS raw_material_type_id, {_day0("o_orderstatus <> 'P'")} FROM orders""",
    "ingredientsrawmaterial_staging": f"""SELECT o_orderkey * 10 + b AS row_id, o_orderkey AS ingredient_rawmaterial_id,
  o_custkey AS ingredient_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT)
    + CASE WHEN o_orderpriority = '1-URGENT' THEN b ELSE 0 END AS raw_material_type_id, {_DAILY} FROM orders {_B}""",
    "ingredients_silver": f"""SELECT {_INGREDIENT.format(cost="abs(s_acctbal) / 1000 + 0.01")},
  {_day0("s_acctbal >= 0")} FROM supplier""",
    "ingredients_staging": f"""SELECT s_suppkey * 10 + b AS row_id, {_INGREDIENT.format(
        cost="CASE WHEN s_acctbal > 5000 THEN abs(s_acctbal) / 1000 + 0.01 + b ELSE abs(s_acctbal) / 1000 + 0.01 END")},
  {_DAILY} FROM supplier {_B}""",
    "recipes_silver": f"""SELECT l_orderkey AS recipe_id, l_partkey AS flavour_id, l_suppkey AS ingredient_id,
  l_quantity AS quantity_grams, l_returnflag AS heat_process, {_day0("l_linestatus = 'O'")} FROM lineitem""",
    "recipes_staging": f"""SELECT line_id * 10 + b AS row_id, l_orderkey AS recipe_id, l_partkey AS flavour_id,
  l_suppkey AS ingredient_id, CASE WHEN l_discount > 0.085 THEN l_quantity + 1 ELSE l_quantity END AS quantity_grams,
  CASE WHEN l_tax > 0.065 THEN concat('X', CAST(b AS VARCHAR)) WHEN l_discount < 0.005 THEN NULL
    ELSE l_returnflag END AS heat_process, {_DAILY} FROM numbered_lines {_B}""",
    "stocks_silver": """SELECT stock_id, flavour_id, quantity_liters, location, batch_value, valid_from,
  CASE WHEN NOT active THEN COALESCE(next_from, valid_from + INTERVAL '1' DAY) END AS valid_to, active,
  valid_from AS load_timestamp, CAST(valid_from AS DATE) AS source_date
FROM (SELECT *, next_from IS NULL AND location <> 'R' AS active FROM (
  SELECT l_suppkey AS stock_id, l_partkey AS flavour_id, l_quantity AS quantity_liters, l_returnflag AS location,
    l_linenumber AS batch_value, l_shipdate AS valid_from, LEAD(l_shipdate) OVER (PARTITION BY l_suppkey, l_partkey
      ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS next_from FROM lineitem) t) u""",
    "stocks_staging": """SELECT line_id AS row_id, l_suppkey AS stock_id,
  CASE WHEN l_tax < 0.075 OR l_discount < 0.085 THEN l_partkey END AS flavour_id,
  CASE WHEN l_linestatus = 'O' THEN l_quantity + 1 ELSE l_quantity END AS quantity_liters,
  CASE WHEN l_discount > 0.005 THEN l_returnflag END AS location, l_shipdate + INTERVAL '30' DAY AS inserted_at,
  l_linenumber AS batch_value, CAST(l_shipdate + INTERVAL '30' DAY AS DATE) AS origin_date, 0 AS merge_status
FROM numbered_lines""",
    "salestransactions_staging": f"""SELECT line_id AS row_id, {_SALE.format(amount="l_extendedprice")},
  l_shipdate AS inserted_at, CAST(l_suppkey % 3 AS INTEGER) AS batch_value, CAST(l_shipdate AS DATE) AS origin_date,
  0 AS merge_status FROM numbered_lines JOIN orders ON l_orderkey = o_orderkey""",
    "salestransactions_silver": f"""SELECT {_SALE.format(amount="l_extendedprice / 2")},
  TIMESTAMP '1990-01-01 00:00:00' AS load_timestamp, DATE '1990-01-01' AS source_date
FROM numbered_lines JOIN orders ON l_orderkey = o_orderkey WHERE line_repeat = 1 AND o_orderstatus = 'F'""",
    "user_history": """SELECT user_id, ts AS valid_from, CASE event_type WHEN 'purchase' THEN following + INTERVAL '1' HOUR
    WHEN 'error' THEN ts - INTERVAL '1' HOUR ELSE following END AS valid_to,
  CASE WHEN event_type = 'error' THEN FALSE ELSE following IS NULL END AS active
FROM (SELECT *, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events) e""",
    "flavour_history": """SELECT l_partkey AS flavour_id, l_shipdate AS valid_from,
  CASE WHEN l_returnflag = 'R' THEN l_shipdate - INTERVAL '1' DAY ELSE following END AS valid_to,
  l_suppkey AS supplier_id, l_quantity AS quantity_liters, CASE WHEN l_discount > 0.02 THEN l_linestatus END AS location
FROM (SELECT *, LEAD(l_shipdate) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, line_id) AS following FROM numbered_lines) f""",
}


def using(tables: list[str], query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` with the derived tables it names (and further steps) in front."""
    wanted = set(tables)
    if any("numbered_lines" in TABLES[t] for t in wanted):
        wanted.add("numbered_lines")
    parts = {t: TABLES[t] for t in TABLES if t in wanted} | (extra or {})
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + "\n" + query


# --- history-keeping merge -----------------------------------------------------------------


def _on(left: str, right: str, columns: tuple[str, ...]) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in columns)


def _cols(alias: str, columns: tuple[str, ...]) -> str:
    return ", ".join(f"{alias}.{c}" for c in columns)


def _opened(spec: MergeSpec, alias: str = "p") -> str:
    return (
        f"{_cols(alias, spec.business)}, {alias}.inserted_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, "
        f"TRUE AS active, {alias}.inserted_at AS load_timestamp, {alias}.origin_date AS source_date"
    )


def _steps(spec: MergeSpec) -> dict[str, str]:
    staging, silver = f"{spec.entity}_staging", f"{spec.entity}_silver"
    named = ", ".join(f"{spec.staging_column(c)} AS {c}" for c in spec.business)
    rows = f"SELECT row_id, {named}, inserted_at, origin_date FROM {staging}"
    keys, on = ", ".join(spec.keys), lambda a, b: _on(a, b, spec.keys)
    steps: dict[str, str] = {}
    if spec.style == "B":
        steps["p"] = f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys}
  ORDER BY inserted_at DESC NULLS LAST, row_id DESC) AS rn FROM ({rows} WHERE merge_status = 0) x) y WHERE rn = 1"""
    elif spec.style == "C":
        # The rows of a key that came with its newest pending load, whether pending or not.
        present = " AND ".join(f"{k} IS NOT NULL" for k in spec.keys)
        steps["p"] = f"""SELECT * EXCLUDE (last_load) FROM (
  SELECT row_id, {named}, inserted_at, origin_date,
    MAX(CASE WHEN merge_status = 0 THEN inserted_at END) OVER (PARTITION BY {keys}) AS last_load FROM {staging}) x
WHERE inserted_at = last_load AND {present}"""
    else:
        steps["p"] = f"{rows} WHERE merge_status = 0"
    steps["act"] = f"SELECT * FROM {silver} WHERE active"
    unseen = (
        f"p.{spec.keys[0]} NOT IN (SELECT {spec.keys[0]} FROM act)"
        if spec.style == "A"
        else f"NOT EXISTS (SELECT 1 FROM act a WHERE {on('a', 'p')})"
    )
    steps["fresh"] = f"SELECT {_opened(spec)} FROM p WHERE {unseen}"
    columns = ", ".join(spec.business) + ", " + _TAIL
    steps["s1"] = f"SELECT {columns} FROM act UNION ALL SELECT {columns} FROM fresh"
    differs = " OR ".join(f"p.{c} <> s.{c}" for c in spec.tracked)
    what = {"A": _cols("p", spec.keys), "D": "p.row_id"}.get(spec.style, _cols("p", spec.keys) + ", p.inserted_at")
    steps["chg"] = f"SELECT DISTINCT {what} FROM p JOIN s1 s ON {on('p', 's')} WHERE {differs}"
    if spec.style == "A":
        steps["ends"] = (
            f"SELECT {_cols('p', spec.keys)}, MAX(p.inserted_at) AS ended FROM p JOIN chg c ON {on('p', 'c')} "
            f"GROUP BY {_cols('p', spec.keys)}"
        )
        chosen = on("p", "c")
    elif spec.style == "D":
        steps["ends"] = (
            f"SELECT {_cols('p', spec.keys)}, MAX(p.inserted_at) AS ended FROM p JOIN chg c ON p.row_id = c.row_id "
            f"GROUP BY {_cols('p', spec.keys)}"
        )
        chosen = "p.row_id = c.row_id"
    else:
        steps["ends"] = f"SELECT {keys}, inserted_at AS ended FROM chg"
        chosen = _on("p", "c", (*spec.keys, "inserted_at"))
    closed = f"{_cols('s', spec.business)}, s.valid_from, e.ended AS valid_to, FALSE AS active, s.load_timestamp, s.source_date"
    steps["closed"] = f"SELECT {closed} FROM s1 s JOIN ends e ON {on('s', 'e')}"
    steps["versions"] = f"SELECT {_opened(spec)} FROM p JOIN chg c ON {chosen}"
    steps["kept"] = f"SELECT {columns} FROM s1 s WHERE NOT EXISTS (SELECT 1 FROM ends e WHERE {on('s', 'e')})"
    if spec.style == "D":
        after = f"(SELECT {columns} FROM kept UNION ALL SELECT {columns} FROM versions)"
        steps["same"] = (
            f"SELECT DISTINCT p.row_id FROM p JOIN {after} s ON {_on('p', 's', spec.business)}"
        )
    return steps


def _merge_query(spec: MergeSpec, query: str) -> str:
    return using([f"{spec.entity}_silver", f"{spec.entity}_staging"], query, _steps(spec))


def merge_result(spec: MergeSpec) -> str:
    columns = ", ".join(spec.business) + ", " + _TAIL
    parts = [f"SELECT {columns} FROM {t}" for t in ("kept", "closed", "versions")]
    parts.append(f"SELECT {columns} FROM {spec.entity}_silver WHERE active IS NOT TRUE")
    return _merge_query(spec, " UNION ALL ".join(parts))


def merge_marked(spec: MergeSpec) -> str:
    keys_in = lambda t: f"EXISTS (SELECT 1 FROM {t} c WHERE {_on('t', 'c', spec.keys)})"
    if spec.style == "A":
        hit = f"merge_status = 0 AND {keys_in('chg')}"
    elif spec.style == "B":
        keys = ", ".join(spec.keys)
        newest = (
            f"(SELECT {keys}, MAX(inserted_at) AS inserted_at FROM {spec.entity}_staging WHERE merge_status = 0 GROUP BY {keys})"
        )
        hit = f"merge_status = 0 AND EXISTS (SELECT 1 FROM {newest} c WHERE {_on('t', 'c', (*spec.keys, 'inserted_at'))})"
    elif spec.style == "C":
        hit = "t.row_id IN (SELECT row_id FROM p)"
    else:
        # New row ids are asked for after the insert, when only rows without a full key are unmatched.
        null_key = " OR ".join(f"t.{k} IS NULL" for k in spec.keys)
        hit = (
            "merge_status = 0 AND (t.row_id IN (SELECT row_id FROM chg) OR t.row_id IN (SELECT row_id FROM same) "
            f"OR {null_key})"
        )
    return _merge_query(
        spec, f"SELECT row_id, CASE WHEN {hit} THEN 1 ELSE merge_status END AS merge_status FROM {spec.entity}_staging t"
    )


def clean_result(spec: MergeSpec) -> str:
    staging, silver = f"{spec.entity}_staging", f"{spec.entity}_silver"
    keys, tracked = ", ".join(spec.keys), ", ".join(spec.tracked)
    named = ", ".join(f"p.{spec.staging_column(c)} AS {c}" for c in spec.business)
    present = " AND ".join(f"p.{k} IS NOT NULL" for k in spec.keys)
    moved = " OR ".join(f"{c} IS DISTINCT FROM was_{c}" for c in spec.tracked)
    steps = {
        "since": f"SELECT {keys}, MAX(valid_from) AS vf FROM {silver} WHERE active GROUP BY {keys}",
        "u": f"""SELECT {keys}, {tracked}, valid_from AS ts, load_timestamp, source_date, CAST(-1 AS BIGINT) AS row_id
  FROM {silver} WHERE active
  UNION ALL SELECT {named}, p.inserted_at, p.inserted_at, p.origin_date, p.row_id
  FROM {staging} p LEFT JOIN since a ON {_on("p", "a", spec.keys)}
  WHERE p.merge_status = 0 AND {present} AND (a.vf IS NULL OR p.inserted_at > a.vf)""",
        "d": f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys}, ts ORDER BY row_id DESC) AS rn FROM u",
        "l": "SELECT *, "
        + ", ".join(f"LAG({c}) OVER w AS was_{c}" for c in spec.tracked)
        + f", LAG(row_id) OVER w AS was_row FROM d WHERE rn = 1 WINDOW w AS (PARTITION BY {keys} ORDER BY ts)",
        "k": f"SELECT * FROM l WHERE was_row IS NULL OR {moved}",
        "v": f"""SELECT {keys}, {tracked}, ts AS valid_from, LEAD(ts) OVER (PARTITION BY {keys} ORDER BY ts) AS valid_to,
  load_timestamp, source_date FROM k""",
    }
    columns = f"{keys}, {tracked}"
    query = f"""SELECT {columns}, valid_from, valid_to, valid_to IS NULL AS active, load_timestamp, source_date FROM v
UNION ALL SELECT {columns}, {_TAIL} FROM {silver} WHERE active IS NOT TRUE"""
    return using([staging, silver], query, steps)


# --- sales and gold --------------------------------------------------------------------------

_SALE_NAMES = ", ".join(SPECS["salestransactions"].business)
_WINNERS = f"""SELECT {_SALE_NAMES}, inserted_at AS load_timestamp, origin_date AS source_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
    ORDER BY batch_value DESC NULLS LAST, inserted_at DESC NULLS LAST, row_id DESC) AS rn
  FROM salestransactions_staging WHERE merge_status = 0) x WHERE rn = 1"""
_UPSERTED = """SELECT * FROM winners UNION ALL
  SELECT * FROM salestransactions_silver WHERE transaction_id NOT IN (SELECT transaction_id FROM winners)"""
_SALES_TABLES = ["salestransactions_silver", "salestransactions_staging"]

_COST = """SELECT r.flavour_id, ROUND(CAST(SUM(CAST(r.quantity_grams AS DECIMAL(18,6)) * CAST(i.cost_per_gram AS DECIMAL(18,6)))
  / NULLIF(SUM(CAST(r.quantity_grams AS DECIMAL(18,6))), 0) AS DECIMAL(18,6)), 2) AS cost_per_liter
FROM recipes_silver r JOIN ingredients_silver i ON r.ingredient_id = i.ingredient_id
WHERE r.active AND i.active GROUP BY r.flavour_id"""

# Names and costs are looked up first; a sale without one of them has no row.
_GOLD = """SELECT DISTINCT transaction_id, customer_id, customer_name, flavour_id, flavour_name, quantity_liters,
  transaction_date, amount_dollar AS revenue, CAST(unit AS DOUBLE) AS cost_per_liter,
  CAST(ROUND(liters * unit, 2) AS DOUBLE) AS total_cost, CAST(ROUND(paid - liters * unit, 2) AS DOUBLE) AS profit
FROM (SELECT *, CAST(quantity_liters AS DECIMAL(18,6)) AS liters, CAST(amount_dollar AS DECIMAL(18,6)) AS paid FROM upserted) sale
JOIN (SELECT flavour_id, name AS flavour_name, cost_per_liter AS unit
  FROM flavours_silver JOIN flavour_cost USING (flavour_id) WHERE active) priced USING (flavour_id)
JOIN (SELECT customer_id, name AS customer_name FROM customers_silver WHERE active) named USING (customer_id)"""
_GOLD_TABLES = [*_SALES_TABLES, "customers_silver", "flavours_silver", "recipes_silver", "ingredients_silver"]


def _sales_query(query: str) -> str:
    return using(_SALES_TABLES, query, {"winners": _WINNERS})


# --- quality -----------------------------------------------------------------------------------


def _count_row(check: str, subject: str, key: str, n: str, severity: str, table: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, '{key}' AS key, CAST({n} AS BIGINT) AS n, "
        f"'{severity}' AS severity FROM {table}"
    )


def _null_rows(subject: str, table: str, groups, severity: str) -> list[str]:
    return [
        _count_row(
            "null_key", subject, "+".join(g),
            "COUNT(*) FILTER (WHERE " + " OR ".join(f"{c} IS NULL" for c in g) + ")", severity, table,
        )
        for g in groups
    ]


def _duplicate(check: str, subject: str, table: str, keys: tuple[str, ...], where: str) -> str:
    label = " || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), 'NULL')" for k in keys)
    return (
        f"SELECT '{check}' AS \"check\", '{subject}' AS subject, {label} AS key, COUNT(*) AS n, 'warning' AS severity "
        f"FROM {table} WHERE {where} GROUP BY {', '.join(keys)} HAVING COUNT(*) > 1"
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# Fixed values, written out here too so that a wrong list on either side shows.
STAGING_KEY = {"customers": "customer_id", "salestransactions": "transaction_id"}
INGREDIENT_CRITICAL = ("ingredient_id", "name", "valid_from", "active")
NULL_KEY_GROUPS: dict[str, tuple[tuple[str, ...], ...]] = {
    "customers": (("customer_id",),),
    "provider": (("provider_id",), ("name",)),
    "flavours": (("flavour_id",), ("name",)),
    "rawmaterialtype": (("raw_material_type_id",), ("name",)),
    "ingredientsrawmaterial": (("ingredient_rawmaterial_id",), ("ingredient_id",), ("raw_material_type_id",)),
    "ingredients": (("ingredient_id", "name", "valid_from", "active"),),
    "recipes": (("recipe_id", "flavour_id", "ingredient_id", "quantity_grams"),),
    "stocks": (("stock_id", "flavour_id"),),
    "salestransactions": (("transaction_id",), ("customer_id",)),
    "gold_sales": (("transaction_id",),),
}


# Rows with a new process come twice.
_RECIPES_REPEATED = f"""SELECT * EXCLUDE (again) REPLACE (row_id * 2 + again AS row_id)
FROM ({TABLES["recipes_staging"]}) t JOIN (VALUES (0), (1)) a(again) ON again = 0 OR heat_process LIKE 'X%'"""


def _unsound(entity: str) -> str:
    lost = ", ".join(f"CASE WHEN {when} THEN NULL ELSE {c} END AS {c}" for c, when in UNSOUND[entity].items())
    return f"SELECT * REPLACE ({lost}) FROM {entity}_silver"


def quality_sql() -> dict[str, str]:
    staging = {e: f"{e}_staging" for e in SPECS}
    silver = {e: f"{e}_silver" for e in SPECS}
    counts = [_count_row("rows", t, "all", "COUNT(*)", "info", t) for t in [*staging.values(), *silver.values()]]
    for e in HISTORY_ENTITIES:
        counts.append(_count_row("rows", silver[e], "active", "COUNT(*) FILTER (WHERE active)", "info", silver[e]))
        counts.append(_count_row("rows", silver[e], "inactive", "COUNT(*) FILTER (WHERE NOT active)", "info", silver[e]))
    merged = {e: _steps(SPECS[e]) for e in HISTORY_ENTITIES}

    def duplicate_active(entity: str) -> str:
        spec = SPECS[entity]
        after = "SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM versions"
        again = {"recipes_staging": _RECIPES_REPEATED} if entity == "recipes" else {}
        return using(
            [silver[entity], staging[entity]],
            _duplicate("duplicate_active", entity, "merged", spec.keys, "active"),
            again | merged[entity] | {"merged": after},
        )

    gold_steps = {"winners": _WINNERS, "upserted": _UPSERTED, "flavour_cost": _COST, "gold": _GOLD}
    null_parts = []
    for e, groups in NULL_KEY_GROUPS.items():
        if e == "gold_sales":
            continue
        null_parts += _null_rows(e, f"{e}_unsound", groups, "error" if e == "ingredients" else "warning")
    null_parts += _null_rows("gold_sales", "gold", NULL_KEY_GROUPS["gold_sales"], "warning")
    return {
        "dq_row_counts": using(
            [*staging.values(), *silver.values()], _union(counts)
        ),
        "dq_null_staging": using(
            list(staging.values()),
            _union(
                [r for e in SPECS for r in _null_rows(e, staging[e], [(STAGING_KEY.get(e, "row_id"),)], "warning")]
            ),
        ),
        "dq_null_keys": using(
            [*silver.values(), *_SALES_TABLES], _union(null_parts),
            gold_steps | {f"{e}_unsound": _unsound(e) for e in SPECS},
        ),
        "dq_null_critical": using(
            ["ingredients_silver"],
            _union(_null_rows("ingredients", "ingredients_unsound", [INGREDIENT_CRITICAL], "error")),
            {"ingredients_unsound": _unsound("ingredients")},
        ),
        "dq_duplicate_transactions": using(
            _GOLD_TABLES,
            _union(
                [
                    _duplicate("duplicate", "staging", "salestransactions_staging", ("transaction_id",), "TRUE"),
                    _duplicate("duplicate", "silver", "upserted", ("transaction_id",), "TRUE"),
                    _duplicate("duplicate", "gold", "gold", ("transaction_id",), "TRUE"),
                ]
            ),
            gold_steps,
        ),
        **{f"dq_duplicate_active_{e}": duplicate_active(e) for e in HISTORY_ENTITIES},
        "dq_overlap_pairs": using(
            ["user_history"],
            # Each user's closed versions as a list; for each, how many others in it it overlaps.
            """SELECT CAST(COALESCE(SUM(list_sum(list_transform(spans, lambda own:
    len(list_filter(spans, lambda other: own <> other AND other.since < own.until AND own.since < other.until))))), 0) AS BIGINT) AS n
FROM (SELECT list({'since': valid_from, 'until': valid_to}) AS spans
  FROM user_history WHERE valid_to IS NOT NULL AND user_id IS NOT NULL GROUP BY user_id) users""",
        ),
        "dq_overlap_keys": using(
            ["user_history"],
            """SELECT user_id, COUNT(*) AS n FROM (SELECT user_id, valid_from, MAX(ended) OVER (PARTITION BY user_id
    ORDER BY valid_from, ended ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_end
  FROM (SELECT user_id, valid_from, COALESCE(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS ended FROM user_history) e) w
WHERE valid_from < before_end GROUP BY user_id""",
        ),
        "dq_date_order": using(
            ["user_history"],
            _count_row(
                "date_order", "user_history", "valid_from>=valid_to",
                "COUNT(*) FILTER (WHERE NOT active AND valid_from >= valid_to)", "error", "user_history",
            ),
        ),
        "dq_unprocessed_recipes": _pending_after("recipes"),
        "dq_unprocessed_stocks": _pending_after("stocks"),
    }


def _pending_after(entity: str) -> str:
    spec = SPECS[entity]
    marked = merge_marked(spec)
    head, query = marked.rsplit("\nSELECT row_id, CASE", 1)
    business = ", ".join(spec.staging_column(c) for c in spec.business)
    return (
        f"{head},\nmarked AS (SELECT row_id, CASE{query})\n"
        f"SELECT row_id, {business}, inserted_at FROM {entity}_staging JOIN marked USING (row_id) WHERE marked.merge_status = 0"
    )


# --- history -----------------------------------------------------------------------------------

_STATES = """SELECT * FROM (SELECT *, COALESCE(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS ended,
  ROW_NUMBER() OVER (PARTITION BY flavour_id, valid_from ORDER BY COALESCE(valid_to, TIMESTAMP '9999-12-31 00:00:00') DESC,
    supplier_id DESC NULLS LAST, quantity_liters DESC NULLS LAST, location DESC NULLS LAST) AS rn FROM flavour_history) h
WHERE rn = 1"""


def history_sql() -> dict[str, str]:
    attributes = ("supplier_id", "quantity_liters", "location")
    as_of = ", ".join(f"CASE WHEN transaction_date < ended THEN v.{c} END AS asof_{c}" for c in attributes)
    before = ", ".join(f"LAG({c}) OVER w AS old_{c}" for c in attributes)
    changes = " UNION ALL ".join(
        f"""SELECT flavour_id, valid_from AS changed_at, '{c}' AS attribute, CAST(old_{c} AS VARCHAR) AS old_value,
  CAST({c} AS VARCHAR) AS new_value FROM steps WHERE place > 1 AND old_{c} IS DISTINCT FROM {c}"""
        for c in attributes
    )
    return {
        "history_asof_sales": using(
            ["flavour_history", "salestransactions_staging"],
            f"""SELECT row_id, transaction_id, s.flavour_id, transaction_date, {as_of}
FROM salestransactions_staging s ASOF LEFT JOIN states v
  ON s.flavour_id = v.flavour_id AND CAST(s.transaction_date AS TIMESTAMP) >= v.valid_from""",
            {"states": _STATES},
        ),
        "history_snapshot": using(
            ["stocks_silver"],
            """SELECT * FROM stocks_silver WHERE valid_from <= TIMESTAMP '1996-07-01 00:00:00'
  AND (valid_to IS NULL OR valid_to > TIMESTAMP '1996-07-01 00:00:00')""",
        ),
        "history_change_log": using(
            ["flavour_history"],
            changes,
            {
                "states": _STATES,
                "steps": f"""SELECT *, ROW_NUMBER() OVER w AS place, {before} FROM states
WINDOW w AS (PARTITION BY flavour_id ORDER BY valid_from)""",
            },
        ),
    }


# --- bronze ------------------------------------------------------------------------------------


def bronze_sql() -> dict[str, str]:
    sales = ", ".join(
        ("transaction_id", "customer_id", "flavour_id", "quantity_liters", "transaction_date", "country", "town",
         "postal_code", "amount_dollar")
    )
    loaded = "TIMESTAMP '2024-05-08 06:00:00' AS inserted_at"
    return {
        "bronze_file_manifest": using(
            ["salestransactions_staging"],
            """SELECT DISTINCT concat('SalesTransactions_', strftime(date_trunc('month', transaction_date), '%Y%m%d'), '_',
    CAST(batch_value AS VARCHAR), '.csv') AS file_name, 'salestransactions' AS table_name,
  'dp_salestransactions_staging' AS staging_table, CAST(date_trunc('month', transaction_date) AS DATE) AS origin_date,
  batch_value, CAST(NULL AS VARCHAR) AS reason FROM salestransactions_staging""",
        ),
        "bronze_parse_filename": """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN concat('Stocks_', d, '_', p, '.csv') WHEN 'O' THEN concat('Recipes_', d, '.csv')
    ELSE 'Customers.csv' END AS file_name,
  CASE o_orderstatus WHEN 'F' THEN 'stocks' WHEN 'O' THEN 'recipes' ELSE 'customers' END AS table_name,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN d END AS date_text,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS origin_date,
  CASE WHEN o_orderstatus = 'F' THEN CAST(p AS INTEGER) ELSE 0 END AS batch_value
FROM (SELECT *, strftime(o_orderdate, '%Y%m%d') AS d, substr(o_orderpriority, 1, 1) AS p FROM orders) o""",
        "bronze_missing_tables": """SELECT staging_table FROM (
  SELECT DISTINCT 'dp_provider_staging' AS staging_table FROM supplier
  UNION SELECT 'dp_ingredients_staging' FROM supplier UNION SELECT 'dp_flavours_staging' FROM part
  UNION SELECT 'dp_rawmaterialtype_staging' FROM part UNION SELECT 'dp_visits_staging' FROM events) t
WHERE staging_table <> 'dp_flavours_staging'""",
        "bronze_csv_scan": using(
            ["salestransactions_staging"],
            f"""SELECT {sales} FROM (SELECT * REPLACE (
  CASE WHEN town = 'R' THEN concat(town, chr(10), '"', postal_code, '", ,') ELSE town END AS town)
FROM salestransactions_staging) s""",
        ),
        "bronze_lineage": using(
            ["customers_staging"],
            f"""SELECT row_id AS "index", customer_id, name, location_city, location_country, {loaded}, batch_value,
  origin_date, merge_status FROM customers_staging""",
        ),
        "bronze_reject_bad_files": using(
            ["stocks_staging"],
            """SELECT DISTINCT 'Stocks_20240506_3.csv' AS file_name, 'bad value' AS reason FROM stocks_staging
  WHERE batch_value = 3 AND location = 'A'
UNION ALL SELECT DISTINCT 'Stocks_20241345_6.csv', 'bad date' FROM stocks_staging WHERE batch_value = 6
UNION ALL SELECT DISTINCT 'Stocks_20240506_seven.csv', 'bad batch' FROM stocks_staging WHERE batch_value = 7""",
        ),
        "bronze_accepted_rows": using(
            ["stocks_staging"],
            f"""SELECT stock_id, flavour_id, quantity_liters, location, {loaded}, batch_value,
  DATE '2024-05-06' AS origin_date, merge_status FROM stocks_staging WHERE batch_value NOT IN (3, 6, 7)""",
        ),
        "bronze_row_id": using(
            ["salestransactions_staging"],
            """SELECT COUNT(*) AS n, COUNT(DISTINCT row_id) AS distinct_ids, CAST(MIN(1) AS BIGINT) AS first_id, COUNT(*) AS last_id
FROM salestransactions_staging""",
        ),
        "bronze_append": using(
            ["recipes_staging"],
            """SELECT origin_date, batch_value, merge_status, COUNT(*) AS n, COUNT(DISTINCT row_id) AS distinct_ids
FROM recipes_staging GROUP BY origin_date, batch_value, merge_status""",
        ),
    }


def layers_sql() -> dict[str, str]:
    changed = " OR ".join(f"LAG({c}) OVER w IS DISTINCT FROM {c}" for c in ("name", "location_city", "location_country"))
    return {
        "layers_customer_history": using(
            ["customers_staging"],
            """SELECT customer_id, name, location_city AS city, location_country AS country, loaded AS valid_from,
  LEAD(loaded) OVER w AS valid_to, LEAD(loaded) OVER w IS NULL AS active, loaded AS load_timestamp, origin_date AS source_date
FROM steps WHERE changed WINDOW w AS (PARTITION BY customer_id ORDER BY loaded)""",
            {
                "steps": f"""SELECT *, ROW_NUMBER() OVER w = 1 OR {changed} AS changed FROM (
  SELECT *, CASE batch_value WHEN 1 THEN TIMESTAMP '2024-05-08 06:00:00' ELSE TIMESTAMP '2024-05-09 06:00:00' END AS loaded
  FROM customers_staging WHERE customer_id IS NOT NULL) l WINDOW w AS (PARTITION BY customer_id ORDER BY loaded)""",
            },
        ),
        "layers_upserted_sales": using(
            ["salestransactions_staging"],
            """SELECT DISTINCT transaction_id, customer_id, transaction_date, load_timestamp, DATE '2024-05-06' AS source_date
FROM (SELECT *, TIMESTAMP '2024-05-08 06:00:00' + to_days(MAX(batch_value) OVER (PARTITION BY transaction_id)) AS load_timestamp
  FROM salestransactions_staging) s""",
        ),
    }


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {
        "gold_sales_analytics": using(
            _GOLD_TABLES, _GOLD, {"winners": _WINNERS, "upserted": _UPSERTED, "flavour_cost": _COST}
        ),
        "gold_refreshed": using(
            [*_GOLD_TABLES, "ingredients_staging"],
            _GOLD,
            _steps(SPECS["ingredients"])
            | {
                "merged": "SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM versions",
                "winners": _WINNERS, "upserted": _UPSERTED,
                "flavour_cost": _COST.replace("JOIN ingredients_silver i", "JOIN merged i"),
            },
        ),
        "gold_cost_per_flavour": using(
            ["recipes_silver", "ingredients_silver"],
            "SELECT flavour_id, CAST(cost_per_liter AS DOUBLE) AS cost_per_liter FROM flavour_cost",
            {"flavour_cost": _COST},
        ),
        "dedupe_latest_sales": _sales_query("SELECT * FROM winners"),
        "scd1_insert_sales": _sales_query(
            "SELECT * FROM winners WHERE transaction_id NOT IN (SELECT transaction_id FROM salestransactions_silver)"
        ),
        "scd1_update_sales": _sales_query(
            "SELECT w.* FROM winners w JOIN salestransactions_silver s ON w.transaction_id = s.transaction_id"
        ),
        "scd1_upsert_sales": _sales_query(_UPSERTED),
        "mark_processed_sales": using(
            ["salestransactions_staging"],
            """SELECT row_id, CASE WHEN rn = 1 THEN 1 ELSE merge_status END AS merge_status FROM (
  SELECT row_id, merge_status, ROW_NUMBER() OVER (PARTITION BY transaction_id
    ORDER BY batch_value DESC NULLS LAST, inserted_at DESC NULLS LAST, row_id DESC) AS rn
  FROM salestransactions_staging WHERE merge_status = 0) x""",
        ),
        "antijoin_not_in": using(
            ["customers_silver", "customers_staging"],
            """SELECT row_id, customer_id, inserted_at FROM customers_staging
WHERE merge_status = 0 AND customer_id NOT IN (SELECT customer_id FROM customers_silver WHERE active)""",
        ),
        "scd2_changed_nullsafe": _merge_query(
            SPECS["customers"],
            """SELECT p.row_id, p.customer_id FROM p JOIN act s ON p.customer_id = s.customer_id
WHERE p.name IS DISTINCT FROM s.name OR p.city IS DISTINCT FROM s.city OR p.country IS DISTINCT FROM s.country""",
        ),
        "scd2_unchanged_stocks": _merge_query(SPECS["stocks"], "SELECT row_id FROM same"),
        "scd2_merge_clean": clean_result(SPECS["customers"]),
    }
    for entity in ("ingredients", "recipes"):
        spec = SPECS[entity]
        keys = ", ".join(spec.keys)
        sql[f"dedupe_latest_{entity}"] = using(
            [f"{entity}_staging"],
            f"""SELECT row_id, {", ".join(spec.business)}, inserted_at FROM (SELECT *, ROW_NUMBER() OVER (
  PARTITION BY {keys} ORDER BY inserted_at DESC NULLS LAST, row_id DESC) AS rn
  FROM {entity}_staging WHERE merge_status = 0) x WHERE rn = 1""",
        )
    for entity in HISTORY_ENTITIES:
        spec = SPECS[entity]
        for key, step in (("new", "fresh"), ("changed", "chg"), ("close", "closed"), ("versions", "versions")):
            sql[f"scd2_{key}_{entity}"] = _merge_query(spec, f"SELECT * FROM {step}")
        sql[f"scd2_merge_{entity}"] = merge_result(spec)
        sql[f"mark_processed_{entity}"] = merge_marked(spec)
        if entity != "customers":
            sql[f"scd2_merge_clean_{entity}"] = clean_result(spec)
    return sql | quality_sql() | history_sql() | bronze_sql() | layers_sql()
