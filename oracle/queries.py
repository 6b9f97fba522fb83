"""One DuckDB query per key of ``queries()``, over the sample files registered as views.

DuckDB divides in floating point, so half-up ratios are taken in HUGEINT. NULL placement is always
explicit. Decimals are compared as DOUBLE, counts as BIGINT and dates as ISO text.
"""

from shopfloor.schemas import EXTRACT

AS_OF = "DATE '2024-02-01'"

TABLES = """
plants AS (
  SELECT s_suppkey AS plant_id, s_name AS plant_name, n_name AS city, r_name AS country,
         concat('T', CAST(s_suppkey % 3 AS VARCHAR)) AS plant_type,
         CAST(s_suppkey * 100 + 5000 AS INT) AS capacity_units,
         CAST(s_suppkey % 450 + 50 AS INT) AS employees_count, s_acctbal > 0 AS is_active
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS product_id, p_brand AS product_code, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_cost, CAST(p_retailprice AS DECIMAL(12,2)) * 2 AS target_price,
         p_size AS lead_time_days, p_size <= 45 AS is_active
  FROM part),
production_runs AS (
  SELECT o_orderkey AS run_id, l.plant_id, l.product_id, CAST(o_orderdate AS DATE) AS run_date,
         o_orderpriority AS shift, concat('Operator-', CAST(o_custkey % 80 + 1 AS VARCHAR)) AS operator,
         l.actual_units + o_orderkey % 5 * 10 AS planned_units, l.actual_units, l.defective_units,
         CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DECIMAL(5,2)) WHEN o_orderkey % 97 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) % 100 AS DECIMAL(5,2)) END AS efficiency_pct,
         CAST(o_orderkey % 181 AS INT) AS downtime_mins
  FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_suppkey) AS plant_id, min(l_partkey) AS product_id,
           CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS actual_units,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) ELSE 0 END) AS BIGINT)
             AS defective_units
    FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l.l_orderkey),
quality_checks AS (
  SELECT l_orderkey * 10 + l_linenumber AS check_id, l_orderkey AS run_id, CAST(l_quantity AS INT) AS sample_size,
         CAST(l_quantity AS INT) - CAST(floor(l_quantity * l_discount) AS INT) AS passed,
         CAST(floor(l_quantity * l_discount) AS INT) AS failed,
         CASE WHEN l_partkey % 6 = 5 THEN NULL ELSE concat('D', CAST(l_partkey % 6 AS VARCHAR)) END AS defect_type,
         CASE WHEN l_suppkey % 4 = 3 THEN NULL ELSE concat('S', CAST(l_suppkey % 4 AS VARCHAR)) END AS severity
  FROM lineitem WHERE l_returnflag = 'R'),
equipment AS (
  SELECT event_id AS equipment_id, user_id AS plant_id, concat('EQ-', CAST(event_id AS VARCHAR)) AS equipment_name,
         event_type AS equipment_type, event_type AS status, CAST(value AS DECIMAL(7,2)) AS efficiency_pct,
         CASE WHEN event_id % 500 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS last_maintenance
  FROM events WHERE user_id % 10 <> 0)"""


def half_up(num: str, den: str, places: int = 2, percent: bool = False) -> str:
    """``num / den`` of non-negative whole numbers, rounded half up; NULL for a zero denominator."""
    scale = 10**places * (100 if percent else 1)
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return f"CAST(({n} * {2 * scale} + {d}) // nullif(2 * {d}, 0) AS DOUBLE) / CAST({10**places} AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return half_up(num, den, 2, percent=True)


def mean2(column: str, places: int = 2) -> str:
    """Mean of a two-place decimal column."""
    return half_up(f"sum(CAST({column} * 100 AS BIGINT))", f"(count({column}) * 100)", places)


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def pearson(x: str, y: str) -> str:
    def s(term: str) -> str:
        return f"sum(CAST({term} AS HUGEINT)) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"

    n, sx, sy = s("1"), s(x), s(y)
    vx = f"({n} * {s(f'({x}) * ({x})')} - {sx} * {sx})"
    vy = f"({n} * {s(f'({y}) * ({y})')} - {sy} * {sy})"
    cov = f"({n} * {s(f'({x}) * ({y})')} - {sx} * {sy})"
    root = f"(sqrt(CAST({vx} AS DOUBLE)) * sqrt(CAST({vy} AS DOUBLE)))"
    return f"round(CAST({cov} AS DOUBLE) / nullif({root}, 0), 6)"


ROLLUP = f"""
rollup_sums AS (
  SELECT run_id, count(check_id) AS total_checks, {big('sum(sample_size)')} AS total_sampled,
         {big('sum(passed)')} AS total_passed, {big('sum(failed)')} AS total_failed,
         {pct('sum(failed)', 'sum(sample_size)')} AS defect_rate_pct
  FROM quality_checks GROUP BY run_id),
defect_mode AS (
  SELECT run_id, defect_type FROM (
    SELECT run_id, defect_type, row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, defect_type ASC) AS place
    FROM quality_checks WHERE defect_type IS NOT NULL GROUP BY run_id, defect_type) WHERE place = 1),
severity_mode AS (
  SELECT run_id, severity FROM (
    SELECT run_id, severity, row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC, severity ASC) AS place
    FROM quality_checks WHERE severity IS NOT NULL GROUP BY run_id, severity) WHERE place = 1),
quality_rollup AS (
  SELECT s.*, d.defect_type AS primary_defect_type, v.severity AS primary_severity
  FROM rollup_sums s LEFT JOIN defect_mode d ON s.run_id = d.run_id LEFT JOIN severity_mode v ON s.run_id = v.run_id)"""

LATEST = f"""
latest_equipment AS (
  SELECT DISTINCT ON (plant_id) plant_id, equipment_name, equipment_type, status AS equipment_status,
         CAST(efficiency_pct AS DOUBLE) AS equipment_efficiency_pct,
         {big(f"date_diff('day', last_maintenance, {AS_OF})")} AS days_since_maintenance
  FROM equipment ORDER BY plant_id, last_maintenance DESC NULLS FIRST, equipment_id)"""

RUN_EXTRACT = f"""
run_extract AS (
  SELECT r.run_id, CAST(r.run_date AS VARCHAR) AS run_date, r.shift, r.operator,
         {big('r.planned_units')} AS planned_units, {big('r.actual_units')} AS actual_units,
         {big('r.defective_units')} AS defective_units, CAST(r.efficiency_pct AS DOUBLE) AS efficiency_pct,
         {big('r.downtime_mins')} AS downtime_mins, {pct('r.actual_units', 'r.planned_units')} AS yield_pct,
         p.plant_name, p.city AS plant_city, p.country AS plant_country, p.plant_type,
         {big('p.capacity_units')} AS plant_capacity, {big('p.employees_count')} AS employees_count,
         d.product_code, d.product_name, d.category AS product_category, CAST(d.unit_cost AS DOUBLE) AS unit_cost,
         CAST(d.target_price AS DOUBLE) AS target_price, {big('d.lead_time_days')} AS lead_time_days,
         q.total_checks, q.total_sampled, q.total_passed, q.total_failed, q.defect_rate_pct,
         q.primary_defect_type, q.primary_severity,
         e.equipment_name, e.equipment_type, e.equipment_status, e.equipment_efficiency_pct, e.days_since_maintenance
  FROM production_runs r JOIN plants p ON r.plant_id = p.plant_id JOIN products d ON r.product_id = d.product_id
  LEFT JOIN quality_rollup q ON r.run_id = q.run_id LEFT JOIN latest_equipment e ON r.plant_id = e.plant_id
  WHERE p.is_active = TRUE AND d.is_active = TRUE)"""

PLANT_RUNS = "production_runs r JOIN plants p ON r.plant_id = p.plant_id"
RATE = f"{pct('sum(r.defective_units)', 'sum(r.actual_units)')} AS defect_rate_pct"
EFFICIENCY = f"{mean2('r.efficiency_pct')} AS avg_efficiency_pct"
RUNS = "count(r.run_id) AS total_runs"
UNITS = big("sum(r.actual_units)")
DEFECTS = f"{big('sum(r.defective_units)')} AS total_defects"
DOWNTIME = f"{big('sum(r.downtime_mins)')} AS total_downtime_mins"

BY_PLANT = f"""SELECT p.plant_name, p.city, {RUNS}, {UNITS} AS total_units_produced, {DEFECTS}, {RATE}, {EFFICIENCY},
       {DOWNTIME}
FROM {PLANT_RUNS} GROUP BY p.plant_id, p.plant_name, p.city"""

BY_SHIFT = f"""SELECT r.shift, {RUNS}, {EFFICIENCY}, {DEFECTS},
       {half_up('sum(r.downtime_mins)', 'count(r.downtime_mins)', 1)} AS avg_downtime_mins
FROM production_runs r GROUP BY r.shift"""

BY_CATEGORY = f"""SELECT d.category AS product_category, count(c.check_id) AS total_checks,
       {big('sum(c.passed)')} AS total_passed, {big('sum(c.failed)')} AS total_failed,
       {pct('sum(c.passed)', '(sum(c.passed) + sum(c.failed))')} AS pass_rate_pct
FROM quality_checks c JOIN production_runs r ON c.run_id = r.run_id JOIN products d ON r.product_id = d.product_id
GROUP BY d.category"""

RANKED = """SELECT r.run_id, p.plant_name, CAST(r.run_date AS VARCHAR) AS run_date, r.shift,
       CAST(r.efficiency_pct AS DOUBLE) AS efficiency_pct, CAST(r.actual_units AS BIGINT) AS actual_units,
       CAST(r.defective_units AS BIGINT) AS defective_units,
       rank() OVER (ORDER BY r.efficiency_pct DESC NULLS FIRST) AS global_efficiency_rank,
       rank() OVER (PARTITION BY r.plant_id ORDER BY r.efficiency_pct DESC NULLS FIRST)
         AS efficiency_rank_within_plant, p.plant_id
FROM production_runs r JOIN plants p ON r.plant_id = p.plant_id"""
RANK_ORDER = "plant_name ASC NULLS LAST, efficiency_rank_within_plant, plant_id, run_id"


def _with(parts: list[str], query: str) -> str:
    return "WITH" + ",".join([TABLES, *parts]) + "\n" + query


def _on_extract(query: str) -> str:
    return _with([ROLLUP, LATEST, RUN_EXTRACT], query)


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _half_even_1(num: str, den: str) -> str:
    n = f"(CAST({num} AS HUGEINT) * 1000)"
    q, rest = f"({n} // {den})", f"(2 * ({n} % {den}))"
    up = f"CASE WHEN {rest} > {den} OR ({rest} = {den} AND {q} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST({q} + {up} AS DOUBLE) / 10.0::DOUBLE"


def _row_counts() -> str:
    names = ["production_runs", "quality_checks", "equipment", "plants", "products"]
    return _with([], _union([f"SELECT '{n}' AS \"table\", count(*) AS total FROM {n}" for n in names]))


def _null_report() -> str:
    counts = _union(
        [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS n FROM run_extract" for c in EXTRACT.fieldNames()]
    )
    return _on_extract(
        f"""SELECT "column", nulls, {_half_even_1('nulls', 'n')} AS null_pct FROM ({counts}) WHERE nulls > 0"""
    )


def _null_rates() -> str:
    columns = ["run_id", "plant_id", "product_id", "efficiency_pct"]
    counts = _union(
        [f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS n FROM production_runs" for c in columns]
    )
    return _with(
        [], f"""SELECT "column", nulls, {pct('nulls', 'n')} AS null_pct, nulls * 100 <= n * 2 AS within_limit FROM ({counts})"""
    )


def _profile(date: str = "run_date") -> str:
    return _on_extract(
        f"""SELECT count(*) AS row_count, {big('34')} AS column_count, min({date}) AS first_run_date,
       max({date}) AS last_run_date, count(DISTINCT plant_name) AS plants,
       count(DISTINCT product_category) AS product_categories,
       {half_up('sum(CAST(round(efficiency_pct * 100) AS BIGINT))', '(count(efficiency_pct) * 100)', 1)}
         AS avg_efficiency_pct
FROM run_extract"""
    )


def _preview_rows() -> str:
    names = ["production_runs", "quality_checks", "equipment", "plants", "products"]
    return _with([], _union([f"SELECT '{n}' AS \"table\", least(10, count(*)) AS preview_rows FROM {n}" for n in names]))


def _completeness() -> str:
    fates = """fates AS (
  SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM plants p WHERE p.plant_id = r.plant_id) THEN 'unknown_plant'
              WHEN NOT EXISTS (SELECT 1 FROM products d WHERE d.product_id = r.product_id) THEN 'unknown_product'
              WHEN NOT EXISTS (SELECT 1 FROM plants p WHERE p.plant_id = r.plant_id AND p.is_active) THEN 'inactive_plant'
              WHEN NOT EXISTS (SELECT 1 FROM products d WHERE d.product_id = r.product_id AND d.is_active)
                THEN 'inactive_product'
              ELSE 'active_runs' END AS fate
  FROM production_runs r)"""
    kinds = ["active_runs", "unknown_plant", "unknown_product", "inactive_plant", "inactive_product"]
    selects = ["SELECT 'source_runs' AS metric, count(*) AS runs FROM fates"]
    selects += [f"SELECT '{k}', count(*) FILTER (WHERE fate = '{k}') FROM fates" for k in kinds]
    selects += ["SELECT 'expected_rows', count(*) FROM run_extract", "SELECT 'extract_rows', count(*) FROM run_extract"]
    return _with([ROLLUP, LATEST, RUN_EXTRACT, "\n" + fates], _union(selects))


def _fan_out() -> str:
    keys = {"plants": "plant_id", "products": "product_id", "production_runs": "run_id", "run_extract": "run_id"}
    selects = []
    for table, key in keys.items():
        name = "extract" if table == "run_extract" else table
        selects.append(
            f"""SELECT '{name}' AS relation, {big('coalesce(sum(n), 0)')} AS row_count, count({key}) AS distinct_keys,
       count(*) FILTER (WHERE n > 1) AS repeated_keys FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""
        )
    return _on_extract(_union(selects))


def _dtype_check(odd: dict[str, str] | None = None) -> str:
    """``odd`` tells for which rows a column's text was made unreadable."""
    return _on_extract(
        _union(
            [
                f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS expected_type, "
                f"count({f.name}) AS filled, count({f.name}) FILTER (WHERE {(odd or {}).get(f.name, 'FALSE')}) AS unreadable FROM run_extract"
                for f in EXTRACT.fields
            ]
        )
    )


def _correlations() -> str:
    days, downtime = "days_since_maintenance", "downtime_mins"

    def cents(c: str) -> str:
        return f"CAST(round({c} * 100) AS BIGINT)"

    pairs = {
        "maintenance_efficiency": (days, cents("efficiency_pct")),
        "maintenance_defect_rate": (days, cents("defect_rate_pct")),
        "downtime_defect_rate": (downtime, cents("defect_rate_pct")),
        "downtime_yield": (downtime, cents("yield_pct")),
    }
    return _on_extract(
        _union(
            [
                f"SELECT '{name}' AS pair, count(*) FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL) AS runs, "
                f"{pearson(x, y)} AS correlation FROM run_extract"
                for name, (x, y) in pairs.items()
            ]
        )
    )


def _downtime() -> str:
    runs = f"""yields AS (
  SELECT r.*, CAST(round({pct('r.actual_units', 'r.planned_units')} * 100) AS BIGINT) AS y FROM production_runs r)"""
    query = f"""SELECT r.plant_id, p.plant_name, r.shift, count(*) AS runs,
       {big('quantile_disc(r.downtime_mins, 0.5)')} AS median_downtime_mins,
       {big('quantile_disc(r.downtime_mins, 0.9)')} AS p90_downtime_mins,
       {half_up('sum(r.y)', '(count(r.y) * 100)')} AS avg_yield_pct,
       {pearson('r.downtime_mins', 'r.y')} AS downtime_yield_correlation
FROM yields r JOIN plants p ON r.plant_id = p.plant_id GROUP BY r.plant_id, p.plant_name, r.shift"""
    return _with(["\n" + runs], query)


def _top_runs() -> str:
    return _with(
        [LATEST],
        f"""SELECT t.shift, d.category AS product_category, e.equipment_status, count(*) AS runs,
       {mean2('t.efficiency_pct')} AS avg_efficiency_pct
FROM (SELECT *, rank() OVER (PARTITION BY plant_id ORDER BY efficiency_pct DESC) AS place
      FROM production_runs WHERE efficiency_pct IS NOT NULL) t
JOIN plants p ON t.plant_id = p.plant_id JOIN products d ON t.product_id = d.product_id
LEFT JOIN latest_equipment e ON t.plant_id = e.plant_id
WHERE t.place <= 10 GROUP BY t.shift, d.category, e.equipment_status""",
    )


def _maintenance() -> str:
    return _on_extract(
        f"""SELECT {big('floor(days_since_maintenance / 30.0) * 30')} AS from_day, count(*) AS runs,
       {half_up('sum(CAST(round(efficiency_pct * 100) AS BIGINT))', '(count(efficiency_pct) * 100)')} AS avg_efficiency_pct,
       {half_up('sum(CAST(round(defect_rate_pct * 100) AS BIGINT))', '(count(defect_rate_pct) * 100)')}
         AS avg_defect_rate_pct,
       {half_up('sum(downtime_mins)', 'count(downtime_mins)', 1)} AS avg_downtime_mins
FROM run_extract GROUP BY 1"""
    )


def _audit() -> str:
    def entry(name: str, rows: str, cols: int, status: str = "success") -> str:
        return f"SELECT '{name}' AS sql_preview, {rows} AS rows, {big(str(cols))} AS cols, '{status}' AS status, TRUE AS timed"

    return _with(
        [ROLLUP],
        _union(
            [
                entry("defect_rate_by_plant", f"(SELECT count(*) FROM ({BY_PLANT}))", 8),
                entry("pass_rate_by_category", f"(SELECT count(*) FROM ({BY_CATEGORY}))", 5),
                entry("quality_rollup", "(SELECT count(*) FROM quality_rollup)", 8),
                entry("SELECT no_such_column FROM global_temp.plants", big("0"), 0, "error"),
            ]
        ),
    )


def _time_rollup() -> str:
    return _with(
        [],
        f"""SELECT CAST(GROUPING(y) + GROUPING(q) + GROUPING(m) AS BIGINT) AS grain, {big('y')} AS "year", {big('q')} AS "quarter",
       CAST(m AS VARCHAR) AS "month", {RUNS}, {UNITS} AS total_units_produced, {DEFECTS}, {RATE}, {EFFICIENCY}, {DOWNTIME}
FROM (SELECT *, year(run_date) AS y, quarter(run_date) AS q, CAST(date_trunc('month', run_date) AS DATE) AS m
      FROM production_runs) r
GROUP BY ROLLUP (y, q, m)""",
    )


SHARES = {"p10": "0.1", "median": "0.5", "p90": "0.9", "p99": "0.99"}
SPEED = "(SELECT *, CAST(actual_units AS DOUBLE) / CAST(downtime_mins + 1 AS DOUBLE) AS speed FROM production_runs)"


def _quantiles() -> str:
    columns = ", ".join(f"quantile_disc(speed, {share}) AS {name}" for name, share in SHARES.items())
    return _with([], f"SELECT plant_id, shift, {columns} FROM {SPEED} WHERE speed IS NOT NULL GROUP BY plant_id, shift")


def _yearly_quantiles() -> str:
    return _with(
        [],
        _union(
            [
                f"""SELECT {big('year(run_date)')} AS "year", CAST({share} AS DOUBLE) AS share, count(speed) AS total,
       quantile_disc(speed, {share}) AS exact, TRUE AS bounded, TRUE AS rank_error_ok
FROM {SPEED} WHERE speed IS NOT NULL GROUP BY 1"""
                for share in SHARES.values()
            ]
        ),
    )


def _distinct_by_year() -> str:
    counted = {"runs": "run_id", "plants": "plant_id", "products": "product_id", "operators": "operator"}
    return _with(
        [],
        _union(
            [
                f"""SELECT {big('year(run_date)')} AS "year", '{name}' AS counted, count(DISTINCT {column}) AS exact, TRUE AS within
FROM production_runs GROUP BY 1"""
                for name, column in counted.items()
            ]
        ),
    )


def _schema_check() -> str:
    """What ``schema_check`` finds in files of which half lack ``operator``, hold ``run_id`` as text and ``added``."""
    rows = []
    for f in EXTRACT.fields:
        kind = f.dataType.simpleString()
        found, partly, status = kind, "FALSE", "ok"
        if f.name == "operator":
            partly, status = "TRUE", "missing"
        if f.name == "run_id":
            found, status = "bigint,string", "retyped"
        rows.append(f"('{f.name}', '{kind}', '{found}', {partly}, '{status}')")
    rows.append("('added', NULL, 'int', TRUE, 'unexpected')")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) t(\"column\", expected_type, found_types, partly, status)"


AUDIT_RUNS = f"""SELECT run, {big('queries')} AS queries, {big('1')} AS errors, {big('"rows"')} AS "rows", TRUE AS timed
FROM (VALUES ('first', 3, 9), ('second', 2, 5)) t(run, queries, "rows")"""

CSV_TEXTS = _on_extract(
    """SELECT * REPLACE ('  ' || shift || ' ' AS shift,
       CASE run_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL
            WHEN 2 THEN 'a' || chr(10) || 'b"c, ' || chr(13) || chr(10) || operator ELSE operator END AS operator)
FROM run_extract"""
)

REJECTED = """SELECT run_id, plant_id, product_id, reason FROM (
  SELECT r.run_id, r.plant_id, r.product_id,
         CASE WHEN p.plant_id IS NULL THEN 'unknown_plant' WHEN d.product_id IS NULL THEN 'unknown_product'
              WHEN NOT coalesce(p.is_active, FALSE) THEN 'inactive_plant'
              WHEN NOT coalesce(d.is_active, FALSE) THEN 'inactive_product' END AS reason
  FROM production_runs r LEFT JOIN plants p ON r.plant_id = p.plant_id LEFT JOIN products d ON r.product_id = d.product_id)
WHERE reason IS NOT NULL"""


def _queries() -> dict[str, str]:
    return {
        "table_row_counts": _row_counts(),
        "schema_param_query": _with(
            [],
            f"""SELECT p.plant_type, {RUNS}, {UNITS} AS total_units, {EFFICIENCY}
FROM {PLANT_RUNS} WHERE r.shift = '1-URGENT' GROUP BY p.plant_type""",
        ),
        "defect_rate_by_plant": _with([], f"{BY_PLANT} ORDER BY defect_rate_pct DESC NULLS FIRST, p.plant_id"),
        "defect_rate_top10": _with(
            [],
            f"""SELECT p.plant_name, p.city, {RUNS}, {DEFECTS}, {RATE}, {EFFICIENCY}
FROM {PLANT_RUNS} GROUP BY p.plant_id, p.plant_name, p.city
ORDER BY defect_rate_pct DESC NULLS FIRST, p.plant_id LIMIT 10""",
        ),
        "efficiency_by_shift": _with([], f"{BY_SHIFT} ORDER BY avg_efficiency_pct DESC NULLS FIRST, r.shift NULLS LAST"),
        "pass_rate_by_category": _with([], f"{BY_CATEGORY} ORDER BY pass_rate_pct DESC NULLS FIRST, d.category NULLS LAST"),
        "pass_rate_by_category_short": _with(
            [], f"SELECT product_category, total_checks, total_passed, pass_rate_pct FROM ({BY_CATEGORY}) "
            "ORDER BY pass_rate_pct DESC NULLS FIRST, product_category NULLS LAST",
        ),
        "quality_rollup": _with([ROLLUP], "SELECT * FROM quality_rollup"),
        "latest_equipment": _with([LATEST], "SELECT * FROM latest_equipment"),
        # Plant names follow the plant ids, which the extract doesn't show.
        "run_extract": _on_extract(
            "SELECT * FROM run_extract ORDER BY run_date DESC NULLS FIRST, plant_name, shift NULLS LAST, run_id"
        ),
        "join_preview_10": _with(
            [LATEST],
            """SELECT r.run_id, CAST(r.run_date AS VARCHAR) AS run_date, r.shift,
       CAST(r.efficiency_pct AS DOUBLE) AS efficiency_pct, p.plant_name, p.city AS plant_city, d.product_name,
       d.category AS product_category, e.equipment_name, e.equipment_status
FROM production_runs r JOIN plants p ON r.plant_id = p.plant_id JOIN products d ON r.product_id = d.product_id
LEFT JOIN latest_equipment e ON r.plant_id = e.plant_id
ORDER BY r.run_date DESC NULLS FIRST, r.run_id LIMIT 10""",
        ),
        "plant_efficiency_summary": _with(
            [],
            f"""SELECT p.plant_name, p.city, {RUNS}, {EFFICIENCY}, {UNITS} AS total_units, {DEFECTS}, {RATE},
       {half_up('sum(r.actual_units)', 'count(r.run_id)', 0)} AS avg_units_per_run
FROM {PLANT_RUNS} GROUP BY p.plant_id, p.plant_name, p.city ORDER BY avg_efficiency_pct DESC NULLS FIRST, p.plant_id""",
        ),
        "plant_efficiency_short": _with(
            [],
            f"""SELECT p.plant_name, {RUNS}, {EFFICIENCY}, {UNITS} AS total_units, {DEFECTS}, {RATE}
FROM {PLANT_RUNS} GROUP BY p.plant_id, p.plant_name ORDER BY avg_efficiency_pct DESC NULLS FIRST, p.plant_id""",
        ),
        "efficiency_rank": _with([], f"SELECT * EXCLUDE (plant_id) FROM ({RANKED})"),
        "efficiency_rank_top50": _with(
            [], f"SELECT * EXCLUDE (plant_id) FROM (SELECT * FROM ({RANKED}) ORDER BY {RANK_ORDER} LIMIT 50)"
        ),
        "efficiency_rank_top20": _with(
            [],
            f"""SELECT plant_name, run_date, shift, efficiency_pct, global_efficiency_rank AS global_rank,
       efficiency_rank_within_plant AS rank_within_plant
FROM (SELECT * FROM ({RANKED}) ORDER BY {RANK_ORDER} LIMIT 20)""",
        ),
        "extract_profile": _profile(),
        "profile_of_text_dates": _profile("CASE WHEN run_id % 3 <> 0 THEN run_date END"),
        "null_report": _null_report(),
        "quality_flags": _on_extract(
            """SELECT count(*) FILTER (WHERE efficiency_pct = 0) AS zero_efficiency_rows,
       count(*) FILTER (WHERE defect_rate_pct > 20) AS high_defect_rate_rows FROM run_extract"""
        ),
        "csv_round_trip": _on_extract("SELECT * FROM run_extract"),
        "parquet_round_trip": _on_extract("SELECT * FROM run_extract"),
        "query_audit": _audit(),
        "completeness": _completeness(),
        "fan_out": _fan_out(),
        "null_rates": _null_rates(),
        "dtype_check": _dtype_check(),
        "dtype_check_odd_texts": _dtype_check({"run_date": "run_id % 3 = 0", "efficiency_pct": "run_id % 4 = 1"}),
        "preview_rows_found": _preview_rows(),
        "csv_text_round_trip": CSV_TEXTS,
        "csv_blocks_round_trip": CSV_TEXTS,
        "schema_check": _schema_check(),
        "audit_runs": AUDIT_RUNS,
        "time_rollup": _time_rollup(),
        "output_quantiles": _quantiles(),
        "output_quantiles_by_year": _yearly_quantiles(),
        "distinct_by_year": _distinct_by_year(),
        "rejected_runs": _with([], REJECTED),
        "bucketed_quality_rollup": _with([ROLLUP], "SELECT * FROM quality_rollup"),
        "bucketed_run_extract": _on_extract("SELECT * FROM run_extract"),
        "bucketed_pass_rate": _with([], BY_CATEGORY),
        "defect_coverage": _on_extract(
            f"""SELECT count(*) AS row_count, count(defect_rate_pct) AS with_defect_rate,
       {pct('count(defect_rate_pct)', 'count(*)')} AS coverage_pct,
       count(defect_rate_pct) * 100 >= count(*) * 80 AS sufficient FROM run_extract"""
        ),
        "defect_by_plant_shift": _with(
            [],
            f"""SELECT p.plant_id, p.plant_name, p.city, r.shift, {RUNS}, {UNITS} AS total_units_produced, {DEFECTS}, {RATE}
FROM {PLANT_RUNS} GROUP BY p.plant_id, p.plant_name, p.city, r.shift""",
        ),
        "maintenance_vs_quality": _maintenance(),
        "quality_correlations": _correlations(),
        "category_vs_target": _with(
            [],
            f"""SELECT product_category, total_checks, pass_rate_pct, target_pct,
       total_passed * 100 < (total_passed + total_failed) * target_pct AS under_target
FROM (SELECT *, CAST(94 + length(product_category) % 4 AS DOUBLE) AS target_pct FROM ({BY_CATEGORY}))""",
        ),
        "downtime_vs_yield": _downtime(),
        "top_run_conditions": _top_runs(),
        "monthly_trend": _with(
            [],
            f"""SELECT CAST(CAST(date_trunc('month', r.run_date) AS DATE) AS VARCHAR) AS "month", {RUNS},
       {UNITS} AS total_units_produced, {DEFECTS}, {RATE}, {EFFICIENCY}, {DOWNTIME}
FROM production_runs r GROUP BY 1""",
        ),
    }


QUERIES = _queries()
