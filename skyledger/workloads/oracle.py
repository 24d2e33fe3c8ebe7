"""DuckDB SQL that states the result of each query independently of the library.

Rounding on the check side: half up is a cast of the printed number to a decimal, half
even is the exact decimal formatting of DuckDB.
"""

from __future__ import annotations

_DAYS = "CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE)"
_DEP = f"CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE {_DAYS} END"
_ARR = f"CASE WHEN l_returnflag = 'R' OR l_linenumber = 7 THEN NULL ELSE {_DAYS} + l_quantity - 25 END"
_CANCELLED = "CASE WHEN l_returnflag = 'R' THEN 1.0e0 ELSE 0.0e0 END"
_MONTH = "CAST(month(o_orderdate) AS INTEGER)"
_FROM = """
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN part ON l_partkey = p_partkey"""

_VOLI = f"""WITH voli AS (
SELECT {_MONTH} AS month, p_brand AS op_unique_carrier, sn.n_name AS origin, cn.n_name AS dest,
       {_DEP} AS dep_delay, {_ARR} AS arr_delay, {_CANCELLED} AS cancelled {_FROM})
"""


def _whole(value: str) -> str:
    return f"CAST(CAST({value} AS BIGINT) AS VARCHAR)"


_VOLI_RAW = f"""WITH voli_raw AS (
SELECT CASE l_orderkey % 101 WHEN 1 THEN 'x' WHEN 2 THEN '' WHEN 3 THEN 'month'
            ELSE CAST({_MONTH} AS VARCHAR) END AS month,
       CASE l_orderkey % 101 WHEN 3 THEN 'op_unique_carrier' WHEN 4 THEN 'OP_Unique_Carrier'
            WHEN 5 THEN ' ' || chr(9) || ' ' WHEN 6 THEN NULL
            ELSE CASE WHEN l_partkey % 3 = 0 THEN '  ' || p_brand || chr(9) ELSE p_brand END
            END AS op_unique_carrier,
       CASE l_partkey % 101 WHEN 7 THEN NULL WHEN 8 THEN '  ' ELSE sn.n_name END AS origin,
       CASE l_partkey % 101 WHEN 9 THEN NULL WHEN 10 THEN '' ELSE cn.n_name END AS dest,
       CASE l_orderkey % 101 WHEN 11 THEN 'None' WHEN 12 THEN '' WHEN 13 THEN 'late' WHEN 14 THEN ' 7.5 '
            ELSE {_whole(_DEP)} END AS dep_delay,
       CASE l_partkey % 101 WHEN 15 THEN ' None ' WHEN 16 THEN '  ' WHEN 17 THEN '1,5'
            ELSE {_whole(_ARR)} END AS arr_delay,
       CASE l_orderkey % 101 WHEN 18 THEN '' WHEN 19 THEN 'n/a' WHEN 20 THEN ' 0'
            ELSE CAST({_CANCELLED} AS VARCHAR) END AS cancelled {_FROM})
"""


def _strip(value: str) -> str:
    return f"trim({value}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _sentinel(value: str) -> str:
    return f"CASE WHEN {_strip(value)} NOT IN ('', 'None') THEN {_strip(value)} END"


def _half_up(value: str, digits: int) -> str:
    return f"CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, {digits})) AS DOUBLE)"


def _half_even(value: str, digits: int) -> str:
    rounded = f"CAST(format('{{:.{digits}f}}', {value}) AS DOUBLE)"
    return f"(CASE WHEN {rounded} = 0 THEN 0.0e0 ELSE {rounded} END)"


def _or_zero(value: str) -> str:
    return f"coalesce({value}, 0.0e0)"


_ROUTE_GROUP = "GROUP BY op_unique_carrier, origin, dest"
_ROUTE_KEYS = "op_unique_carrier AS carrier, origin, dest"
_OPERATED_DEP = "CASE WHEN cancelled = 0 THEN dep_delay END"
_OPERATED_ARR = "CASE WHEN cancelled = 0 THEN arr_delay END"
_LABEL = "origin || ' -> ' || dest"
_MONTHS_INT = "array_to_string(list_sort(list(DISTINCT month)), ',')"
_MONTHS_TEXT = "array_to_string(list_sort(list(DISTINCT CAST(month AS VARCHAR))), ',')"


def _route_stats(delay: str, extreme, mean, rate, months: str) -> str:
    return f"""
SELECT op_unique_carrier AS "Compagnia", {_LABEL} AS "Tratta", count(*) AS "Voli",
       {extreme(f"min({delay})")} AS "Min", {extreme(f"max({delay})")} AS "Max",
       {mean(f"avg({delay})")} AS "Medio", {rate("avg(cancelled)")} AS "Cancellazioni",
       {months} AS "Mesi"
FROM voli {_ROUTE_GROUP}"""


_ROUTE_ARR = _route_stats(
    _OPERATED_ARR, lambda e: e, lambda e: _half_even(e, 2), lambda e: _half_even(e, 4), _MONTHS_INT
)
_ROUTE_DEP_FLAT = _route_stats(
    _OPERATED_DEP, lambda e: e, lambda e: _half_up(e, 2), lambda e: _half_up(e, 4), _MONTHS_TEXT
)
_ROUTE_DEP_NESTED = _route_stats(
    _OPERATED_DEP,
    lambda e: _or_zero(_half_up(e, 2)),
    lambda e: _or_zero(_half_up(e, 2)),
    lambda e: _half_up(e, 4),
    _MONTHS_INT,
)

_RANKING_COLUMNS = """origin AS "Aeroporto", CAST(pos AS INTEGER) AS "Posizione_Classifica",
       carrier AS "Compagnia", flights AS "Voli_Operati", dep AS "Ritardo_Medio_Partenza",
       arr AS "Ritardo_Medio_Arrivo", rate AS "Tasso_Cancellazione", diff AS "Differenza_Dalla_Media_APT" """

_RANKING_SQL = f""", pairs AS (
SELECT origin, op_unique_carrier AS carrier, count(*) AS flights,
       sum({_OPERATED_DEP}) AS s, count({_OPERATED_DEP}) AS n,
       {_half_up(f"avg({_OPERATED_DEP})", 2)} AS dep, {_half_up(f"avg({_OPERATED_ARR})", 2)} AS arr,
       {_half_up("avg(cancelled)", 4)} AS rate
FROM voli GROUP BY origin, op_unique_carrier),
compared AS (
SELECT *, sum(s) OVER (PARTITION BY origin) / nullif(sum(n) OVER (PARTITION BY origin), 0) AS airport,
       dense_rank() OVER (PARTITION BY origin ORDER BY dep ASC NULLS FIRST) AS pos
FROM pairs),
ranking AS (SELECT *, {_half_up("(dep - airport)", 2)} AS diff FROM compared)
"""


def _ranking_zero(source: str, carrier: str, airport: str, valid: str, airport_digits: int | None) -> str:
    """Missing delays as 0. ``carrier`` and ``airport``: "all" or "operated" delays summed."""

    def total(column: str, over: str) -> str:
        value = _or_zero(column)
        return f"sum({value})" if over == "all" else f"sum(CASE WHEN cancelled = 0 THEN {value} ELSE 0.0e0 END)"

    mean = "CASE WHEN sum(v) > 0 THEN sum(a) / sum(v) ELSE 0.0e0 END"
    return f""", sums AS (
SELECT origin, op_unique_carrier AS carrier, count(*) AS flights, sum(cancelled) AS c,
       {total("dep_delay", carrier)} AS d, {total("arr_delay", carrier)} AS r,
       {total("dep_delay", airport)} AS a, CAST({valid} AS DOUBLE) AS v
FROM {source} GROUP BY origin, op_unique_carrier),
airports AS (
SELECT origin, {_half_even(mean, airport_digits) if airport_digits is not None else mean} AS airport
FROM sums GROUP BY origin),
means AS (
SELECT origin, carrier, flights, airport, {_half_even("(c / flights)", 4)} AS rate,
       CASE WHEN v > 0 THEN {_half_even("(d / v)", 2)} ELSE 0.0e0 END AS dep,
       CASE WHEN v > 0 THEN {_half_even("(r / v)", 2)} ELSE 0.0e0 END AS arr
FROM sums JOIN airports USING (origin)),
ranking AS (
SELECT *, {_half_even("(dep - airport)", 2)} AS diff,
       row_number() OVER (PARTITION BY origin ORDER BY dep, carrier) AS pos
FROM means)
"""


_OPERATED_COUNT = "count(*) FILTER (cancelled = 0)"
_ZERO_DEDUPE = _ranking_zero("(SELECT DISTINCT * FROM voli)", "all", "all", "count(*) - sum(cancelled)", 2)
_ZERO_EXCL = _ranking_zero("voli", "operated", "operated", _OPERATED_COUNT, 2)
_ZERO_INCL = _ranking_zero("voli", "all", "operated", _OPERATED_COUNT, None)

_RANKING_LINE = """SELECT origin || chr(9) || concat_ws(';', pos, carrier, flights, CAST(dep AS VARCHAR),
       CAST(arr AS VARCHAR), CAST(rate AS VARCHAR), CAST(diff AS VARCHAR)) AS line FROM ranking"""

_PAIR_MEANS = f""", pairs AS (
SELECT origin, op_unique_carrier AS carrier, sum({_OPERATED_DEP}) AS s,
       CAST(count({_OPERATED_DEP}) AS DOUBLE) AS n, {_half_up(f"avg({_OPERATED_DEP})", 2)} AS dep_mean
FROM voli GROUP BY origin, op_unique_carrier)
"""

_KEYS_FILLED = " AND ".join(f"{_strip(c)} <> ''" for c in ("op_unique_carrier", "origin", "dest"))
_TYPED = f"""SELECT TRY_CAST({_strip("month")} AS INTEGER) AS month,
       {_strip("op_unique_carrier")} AS op_unique_carrier, {_strip("origin")} AS origin, {_strip("dest")} AS dest,
       TRY_CAST({_sentinel("dep_delay")} AS DOUBLE) AS dep_delay,
       TRY_CAST({_sentinel("arr_delay")} AS DOUBLE) AS arr_delay,
       TRY_CAST({_strip("cancelled")} AS DOUBLE) AS cancelled
FROM voli_raw
WHERE TRY_CAST({_strip("month")} AS INTEGER) IS NOT NULL
  AND TRY_CAST({_strip("cancelled")} AS DOUBLE) IS NOT NULL
  AND ({_sentinel("dep_delay")} IS NULL OR TRY_CAST({_strip("dep_delay")} AS DOUBLE) IS NOT NULL)
  AND ({_sentinel("arr_delay")} IS NULL OR TRY_CAST({_strip("arr_delay")} AS DOUBLE) IS NOT NULL)"""

_AIRPORT_MEAN_ZERO = f"sum(CASE WHEN cancelled = 0 THEN {_or_zero('dep_delay')} END) / {_OPERATED_COUNT}"


def _lookup() -> str:
    dep = f"CASE WHEN v > 0 THEN {_half_even('(d / v)', 2)} ELSE 0.0e0 END"
    return f""", pairs AS (
SELECT origin, op_unique_carrier AS carrier, {_OPERATED_COUNT} AS v,
       sum(CASE WHEN cancelled = 0 THEN {_or_zero("dep_delay")} ELSE 0.0e0 END) AS d
FROM voli GROUP BY origin, op_unique_carrier),
means AS (
SELECT origin, {_half_even(f"avg({_or_zero('dep_delay')})", 2)} AS m
FROM voli WHERE cancelled = 0 GROUP BY origin),
joined AS (
SELECT origin, carrier, {dep} AS dep_mean, {_or_zero("m")} AS airport_mean
FROM pairs LEFT JOIN means USING (origin))
SELECT *, {_half_even("(dep_mean - airport_mean)", 2)} AS difference FROM joined"""


def _number(value: str) -> str:
    return f"TRY_CAST({_sentinel(value)} AS DOUBLE)"


def _fine(value: str) -> str:
    """A number or missing."""
    return f"({_sentinel(value)} IS NULL OR {_number(value)} IS NOT NULL)"


def _named(*keys: str) -> str:
    return " AND ".join(f"coalesce({_strip(k)} <> '' AND {_strip(k)} <> '{k}', false)" for k in keys)


def _raw_flights(where: str, flag: str = _number("cancelled"), counted: str = "true") -> str:
    """Typed flights of the raw table that a job's own rules let through."""
    return f"""{_VOLI_RAW}, voli AS (
SELECT TRY_CAST({_strip("month")} AS INTEGER) AS month, {_strip("op_unique_carrier")} AS op_unique_carrier,
       {_strip("origin")} AS origin, {_strip("dest")} AS dest, {_number("dep_delay")} AS dep_delay,
       {_number("arr_delay")} AS arr_delay, {flag} AS cancelled, {counted} AS counted
FROM voli_raw WHERE {where})
"""


_FLAG = _number("cancelled")
_FLAG_OR_0 = f"coalesce({_FLAG}, 0.0e0)"
_AIRPORT_ROWS = f"""{_named("origin")} AND {_fine("cancelled")} AND ({_FLAG_OR_0} <> 0 OR {_fine("dep_delay")})"""
_MONTH_FINE = f"({_sentinel('month')} IS NULL OR TRY_CAST({_strip('month')} AS INTEGER) IS NOT NULL)"


def _job_ranking_zero(counted: str, delay: str, digits: int | None) -> str:
    """Carriers over the counted flights, the airport's mean over all that its own rule lets through."""
    airport = f"coalesce(avg(CASE WHEN cancelled = 0 THEN {_or_zero('dep_delay')} END), 0.0e0)"

    def total(column: str) -> str:
        return f"sum(CASE WHEN {delay} THEN {_or_zero(column)} ELSE 0.0e0 END)"

    return f"""{_raw_flights(_AIRPORT_ROWS, _FLAG_OR_0, counted)}, airports AS (
SELECT origin, {airport if digits is None else _half_even(airport, digits)} AS airport FROM voli GROUP BY origin),
sums AS (
SELECT origin, op_unique_carrier AS carrier, count(*) AS flights, sum(cancelled) AS c,
       {total("dep_delay")} AS d, {total("arr_delay")} AS r, {_OPERATED_COUNT} AS v
FROM voli WHERE counted GROUP BY origin, op_unique_carrier),
means AS (
SELECT origin, carrier, flights, airport, {_half_even("(c / flights)", 4)} AS rate,
       CASE WHEN v > 0 THEN {_half_even("(d / v)", 2)} ELSE 0.0e0 END AS dep,
       CASE WHEN v > 0 THEN {_half_even("(r / v)", 2)} ELSE 0.0e0 END AS arr
FROM sums JOIN airports USING (origin)),
ranking AS (
SELECT *, {_half_even("(dep - airport)", 2)} AS diff,
       row_number() OVER (PARTITION BY origin ORDER BY dep, carrier) AS pos
FROM means)
SELECT {_RANKING_COLUMNS} FROM ranking"""


_PAIR_NAMED = _named("origin", "op_unique_carrier")
_ROUTE_NAMED = _named("origin", "op_unique_carrier", "dest")
_JOB_RANKING_SQL = _raw_flights(
    f"""{_PAIR_NAMED} AND {_fine("cancelled")}
    AND (coalesce({_FLAG} <> 0, true) OR ({_fine("dep_delay")} AND {_fine("arr_delay")}))"""
)
_JOB_ROUTE_ARR = _raw_flights(
    f"""{_ROUTE_NAMED} AND TRY_CAST({_strip("month")} AS INTEGER) IS NOT NULL AND {_FLAG} IS NOT NULL
    AND (trunc({_FLAG}) = 1 OR {_fine("arr_delay")})"""
)
_JOB_ROUTE_DEP = _raw_flights(
    f"""{_ROUTE_NAMED} AND {_MONTH_FINE} AND {_fine("cancelled")}
    AND (coalesce({_FLAG} <> 0, true) OR {_fine("dep_delay")})"""
)


_JOB_DEDUPE = f"""{_VOLI_RAW}, voli AS (
SELECT * REPLACE ({_or_zero("cancelled")} AS cancelled) FROM (
SELECT DISTINCT {_strip("op_unique_carrier")} AS op_unique_carrier, {_strip("origin")} AS origin, {_number("dep_delay")} AS dep_delay,
       {_number("arr_delay")} AS arr_delay, {_number("cancelled")} AS cancelled, month, dest
FROM voli_raw WHERE {_PAIR_NAMED} AND {_fine("cancelled")} AND {_fine("dep_delay")} AND {_fine("arr_delay")}))
{_ranking_zero("voli", "all", "all", "count(*) - sum(cancelled)", 2)}"""


def _reasons() -> str:
    keys = "".join(
        f" WHEN NOT coalesce({_strip(k)} <> '', false) THEN 'blank {k}' WHEN {_strip(k)} = '{k}' THEN 'header in {k}'"
        for k in ("op_unique_carrier", "origin", "dest")
    )
    month = f"TRY_CAST({_strip('month')} AS INTEGER) IS NULL"
    return f"""CASE{keys} WHEN {_sentinel("cancelled")} IS NULL THEN 'missing cancelled' WHEN {_number("cancelled")} IS NULL THEN 'bad cancelled'
       WHEN {_sentinel("month")} IS NULL THEN 'missing month' WHEN {month} THEN 'bad month'
       WHEN NOT {_fine("dep_delay")} THEN 'bad dep_delay' WHEN NOT {_fine("arr_delay")} THEN 'bad arr_delay' ELSE 'kept' END"""


_COLUMNS = ("month", "op_unique_carrier", "origin", "dest", "dep_delay", "arr_delay", "cancelled")


def _ranks(table: str) -> str:
    """Least type that holds all values of each column, as a number."""
    rows = []
    for column in _COLUMNS:
        text = f"CAST({column} AS VARCHAR)"
        rows.append(f"""SELECT '{column}' AS "column", max(CASE WHEN {_sentinel(text)} IS NULL THEN 0
       WHEN TRY_CAST({_strip(text)} AS INTEGER) IS NOT NULL AND regexp_full_match({_strip(text)}, '[+-]?[0-9]+') THEN 1
       WHEN TRY_CAST({_strip(text)} AS BIGINT) IS NOT NULL AND regexp_full_match({_strip(text)}, '[+-]?[0-9]+') THEN 2
       WHEN TRY_CAST({_strip(text)} AS DOUBLE) IS NOT NULL THEN 3 ELSE 4 END) AS rank FROM {table}""")
    return " UNION ALL ".join(rows)


_INFERRED = f"""{_VOLI}, {_VOLI_RAW.strip().removeprefix("WITH ")},
ranks AS (SELECT 'raw' AS source, * FROM ({_ranks("voli_raw")}) UNION ALL SELECT 'clean', * FROM ({_ranks("voli")}))
SELECT source, "column", (['void', 'int', 'bigint', 'double', 'string'])[rank + 1] AS type
FROM (SELECT * FROM ranks UNION ALL SELECT 'both', "column", max(rank) FROM ranks GROUP BY "column")"""


def _by_route(columns: str) -> str:
    return f"{_VOLI} SELECT {_ROUTE_KEYS}, {columns} FROM voli {_ROUTE_GROUP}"


ORACLE: dict[str, str] = {
    "route_stats_arr": _VOLI + _ROUTE_ARR,
    "route_stats_dep_flat": _VOLI + _ROUTE_DEP_FLAT,
    "route_stats_dep_nested": _VOLI + _ROUTE_DEP_NESTED,
    "ranking_sql": f"{_VOLI}{_RANKING_SQL} SELECT {_RANKING_COLUMNS} FROM ranking",
    "ranking_zero_dedupe": f"{_VOLI}{_ZERO_DEDUPE} SELECT {_RANKING_COLUMNS} FROM ranking",
    "ranking_zero_excl": f"{_VOLI}{_ZERO_EXCL} SELECT {_RANKING_COLUMNS} FROM ranking",
    "ranking_zero_incl": f"{_VOLI}{_ZERO_INCL} SELECT {_RANKING_COLUMNS} FROM ranking",
    "scan_csv": _VOLI + "SELECT * FROM voli",
    "resolve_columns": _VOLI_RAW + "SELECT * FROM voli_raw",
    "clean_flights": f"""{_VOLI_RAW}, typed AS ({_TYPED})
SELECT * FROM typed WHERE op_unique_carrier <> 'op_unique_carrier' AND {_KEYS_FILLED}""",
    "resolve_mixed_files": _VOLI + "SELECT * FROM voli",
    "resolve_by_layout": _VOLI + "SELECT * FROM voli",
    "infer_types": _INFERRED,
    "scan_quoted_breaks": f"""{_VOLI_RAW} SELECT op_unique_carrier, 'from ' || coalesce(origin, '')
|| CASE month WHEN '7' THEN chr(10) WHEN '3' THEN '"' || chr(10) || chr(10) || ', "' ELSE ' to ' END || coalesce(dest, '')
|| CASE WHEN month = '5' THEN chr(10) || '"' ELSE '' END AS note, dep_delay FROM voli_raw""",
    "reject_reasons": f"{_VOLI_RAW} SELECT {_reasons()} AS reason, count(*) AS lines FROM voli_raw GROUP BY ALL",
    "sink_csv_raw_roundtrip": _VOLI_RAW + "SELECT * FROM voli_raw",
    "sink_overwrite": f"""{_VOLI} SELECT origin, avg({_or_zero("dep_delay")}) AS airport_mean
FROM voli WHERE cancelled = 0 GROUP BY origin""",
    "job_ranking_sql": f"{_JOB_RANKING_SQL}{_RANKING_SQL} SELECT {_RANKING_COLUMNS} FROM ranking",
    "job_ranking_zero_excl": _job_ranking_zero(
        f"{_PAIR_NAMED} AND ({_FLAG_OR_0} <> 0 OR {_fine('arr_delay')})", "cancelled = 0", 2
    ),
    "job_ranking_zero_incl": _job_ranking_zero(
        f"{_PAIR_NAMED} AND {_fine('arr_delay')} AND {_fine('dep_delay')}", "true", None
    ),
    "job_route_stats_arr": _JOB_ROUTE_ARR + _ROUTE_ARR,
    "job_route_stats_dep_flat": f"""{_JOB_ROUTE_DEP}
SELECT * REPLACE (coalesce("Mesi", '') AS "Mesi") FROM ({_ROUTE_DEP_FLAT})""",
    "job_ranking_zero_dedupe": f"{_JOB_DEDUPE} SELECT {_RANKING_COLUMNS} FROM ranking",
    "job_route_stats_dep_nested": f"""{_JOB_ROUTE_DEP}
SELECT * REPLACE (coalesce("Mesi", '') AS "Mesi") FROM ({_ROUTE_DEP_NESTED})""",
    "route_state_merge": _VOLI + _ROUTE_ARR,
    "job_airport_mean": f"""{_raw_flights(_AIRPORT_ROWS, _FLAG_OR_0)}
SELECT origin, {_half_even(f"avg({_or_zero('dep_delay')})", 2)} AS airport_mean
FROM voli WHERE cancelled = 0 GROUP BY origin""",
    "sink_json_roundtrip": f"{_VOLI}{_RANKING_SQL} SELECT {_RANKING_COLUMNS} FROM ranking",
    "sink_csv_roundtrip": _VOLI + _ROUTE_DEP_FLAT,
    "sink_text_roundtrip": _VOLI + _ZERO_DEDUPE + _RANKING_LINE,
    "sink_means_roundtrip": f"""{_VOLI} SELECT origin, avg({_or_zero("dep_delay")}) AS airport_mean
FROM voli WHERE cancelled = 0 GROUP BY origin""",
    "report_line_ranking": _VOLI + _ZERO_INCL + _RANKING_LINE,
    "report_line_route": f"""{_VOLI}, stats AS ({_ROUTE_ARR})
SELECT "Compagnia" || chr(9) || concat_ws(';', "Tratta", "Voli", coalesce(CAST("Min" AS VARCHAR), 'NULL'),
       coalesce(CAST("Max" AS VARCHAR), 'NULL'), coalesce(CAST("Medio" AS VARCHAR), 'NULL'),
       coalesce(CAST("Cancellazioni" AS VARCHAR), 'NULL'), '[' || "Mesi" || ']') AS line
FROM stats""",
    "report_line_json": _VOLI + _ROUTE_ARR,
    "preview_top10": _VOLI + _ROUTE_DEP_FLAT + ' ORDER BY "Compagnia", "Tratta" LIMIT 10',
    "temp_view_sql": f"""{_VOLI} SELECT origin, month, count(*) AS flights,
count(CASE WHEN cancelled = 1 THEN 1 END) AS cancelled_flights, max({_OPERATED_DEP}) AS worst_departure
FROM voli GROUP BY origin, month""",
    "project_flights": _VOLI
    + "SELECT origin, op_unique_carrier AS carrier, dep_delay, arr_delay, cancelled FROM voli",
    "drop_malformed": _VOLI_RAW + _TYPED,
    "filter_not_null": _VOLI_RAW
    + "SELECT * FROM voli_raw WHERE op_unique_carrier IS NOT NULL AND origin IS NOT NULL AND dest IS NOT NULL",
    "filter_blank_keys": f"{_VOLI_RAW} SELECT * FROM voli_raw WHERE {_KEYS_FILLED}",
    "filter_embedded_header": _VOLI_RAW
    + "SELECT * FROM voli_raw WHERE op_unique_carrier <> 'op_unique_carrier'",
    "filter_contains_ci": _VOLI_RAW
    + """SELECT * FROM voli_raw WHERE coalesce(lower(month), '') NOT LIKE '%month%'
AND position('op_unique_carrier' IN coalesce(lower(op_unique_carrier), '')) = 0""",
    "filter_operated": _VOLI + "SELECT * FROM voli WHERE cancelled = 0",
    "join_airport_mean": _VOLI + _lookup(),
    "join_side_table": _VOLI + _lookup(),
    "agg_count": _by_route("count(*) AS flights"),
    "agg_min_max": _by_route(f"min({_OPERATED_DEP}) AS delay_min, max({_OPERATED_DEP}) AS delay_max"),
    "agg_cond_avg": _by_route(f"avg({_OPERATED_DEP}) AS delay_mean"),
    "agg_cond_sum_count": _by_route(
        f"sum({_OPERATED_DEP}) AS delay_sum, count({_OPERATED_DEP}) AS delay_flights"
    ),
    "agg_cancel_rate": _by_route(f"{_half_up('avg(cancelled)', 4)} AS rate"),
    "agg_months_set": f"{_VOLI} SELECT DISTINCT {_ROUTE_KEYS}, month FROM voli",
    "months_text": _by_route(f"{_MONTHS_TEXT} AS months"),
    "pair_sums": f"""{_VOLI} SELECT origin, op_unique_carrier AS carrier, count(*) AS flights,
sum(cancelled) AS cancelled_sum, sum({_or_zero("dep_delay")}) AS dep_sum, sum({_or_zero("arr_delay")}) AS arr_sum,
count(*) - sum(cancelled) AS valid_flights FROM voli GROUP BY origin, op_unique_carrier""",
    "airport_mean": f"""{_VOLI} SELECT origin, {_or_zero(_AIRPORT_MEAN_ZERO)} AS airport_mean
FROM voli GROUP BY origin""",
    "airport_mean_operated": f"""{_VOLI} SELECT origin, {_half_even(f"avg({_or_zero('dep_delay')})", 2)} AS airport_mean
FROM voli WHERE cancelled = 0 GROUP BY origin""",
    "dedupe_rows": _VOLI + "SELECT DISTINCT * FROM voli",
    "dedupe_by_digest": _VOLI + "SELECT DISTINCT * FROM voli",
    "nest_routes": f"""{_VOLI}, stats AS ({_ROUTE_DEP_NESTED})
SELECT *, CAST(row_number() OVER (PARTITION BY "Compagnia" ORDER BY "Tratta") - 1 AS INTEGER) AS "index" FROM stats""",
    "nest_ranking": f"""{_VOLI}{_RANKING_SQL} SELECT {_RANKING_COLUMNS},
CAST(row_number() OVER (PARTITION BY origin ORDER BY pos, carrier) - 1 AS INTEGER) AS "index" FROM ranking""",
    "win_airport_sum": f"""{_VOLI}{_PAIR_MEANS} SELECT origin, carrier,
sum(s) OVER (PARTITION BY origin) AS airport_sum, sum(n) OVER (PARTITION BY origin) AS airport_flights FROM pairs""",
    "rank_dense": f"""{_VOLI}{_PAIR_MEANS} SELECT origin, carrier, dep_mean, CAST(dense_rank() OVER
(PARTITION BY origin ORDER BY dep_mean ASC NULLS FIRST) AS INTEGER) AS position FROM pairs""",
    "rank_row_number": f"""{_VOLI}{_PAIR_MEANS} SELECT origin, carrier, dep_mean, CAST(row_number() OVER
(PARTITION BY origin ORDER BY dep_mean ASC NULLS FIRST, carrier) AS INTEGER) AS position FROM pairs""",
    "diff_from_airport": f"""{_VOLI}{_PAIR_MEANS}, compared AS (SELECT *, sum(s) OVER (PARTITION BY origin)
/ nullif(sum(n) OVER (PARTITION BY origin), 0) AS airport FROM pairs)
SELECT origin, carrier, {_half_up("(dep_mean - airport)", 2)} AS difference FROM compared""",
    "sort_airport_mean": f"""{_VOLI}{_PAIR_MEANS} SELECT origin, carrier, dep_mean FROM pairs
ORDER BY origin, dep_mean ASC NULLS FIRST, carrier""",
    "route_label": f"{_VOLI} SELECT {_LABEL} AS route FROM voli",
    "round_half_up": _by_route(f"{_half_up(f'avg({_OPERATED_DEP})', 2)} AS delay_mean"),
    "round_half_even": _by_route(f"{_half_even(f'avg({_OPERATED_DEP})', 2)} AS delay_mean"),
    "coalesce_zero": f"""{_VOLI} SELECT origin, {_or_zero("dep_delay")} AS dep_delay,
{_or_zero("arr_delay")} AS arr_delay FROM voli""",
    "null_sentinel": f"""{_VOLI_RAW} SELECT {_sentinel("dep_delay")} AS dep_delay,
{_sentinel("arr_delay")} AS arr_delay FROM voli_raw""",
    "try_cast_numeric": f"""{_VOLI_RAW}
SELECT coalesce(TRY_CAST({_strip("month")} AS INTEGER), -1) AS month_or_minus_one,
TRY_CAST({_strip("dep_delay")} AS DOUBLE) AS dep_delay,
TRY_CAST({_strip("cancelled")} AS DOUBLE) AS cancelled FROM voli_raw""",
    "trim_lower": f"""{_VOLI_RAW} SELECT lower({_strip("op_unique_carrier")}) AS carrier,
coalesce(position('unique' IN lower(op_unique_carrier)) > 0, false) AS is_header,
{_strip("origin")} AS origin FROM voli_raw""",
    "json_struct_roundtrip": _VOLI + "SELECT * FROM voli",
    "split_delimited": f"""{_VOLI} SELECT origin, op_unique_carrier AS carrier, {_or_zero("dep_delay")} AS dep_delay,
{_or_zero("arr_delay")} AS arr_delay, cancelled FROM voli""",
    "safe_divide": _by_route(
        f"coalesce(avg({_OPERATED_DEP}), 0.0e0) AS mean_or_zero, avg({_OPERATED_DEP}) AS mean_or_null"
    ),
}


def _one_shape(name: str, *columns: str) -> str:
    kinds = ("VARCHAR", "VARCHAR", "BIGINT", "DOUBLE", "DOUBLE", "DOUBLE", "DOUBLE", "INTEGER", "VARCHAR")
    names = ("carrier", "place", "flights", "x1", "x2", "x3", "rate", "position", "months")
    shown = ", ".join(f"CAST({column} AS {kind}) AS {alias}" for column, kind, alias in zip(columns, kinds, names))
    return f"SELECT '{name}' AS job, {shown} FROM ({_ALL_REPORTS[name]})"


_ALL_REPORTS = {
    "route_stats_arr": ORACLE["job_route_stats_arr"],
    "route_stats_dep_flat": ORACLE["job_route_stats_dep_flat"],
    "route_stats_dep_nested": ORACLE["job_route_stats_dep_nested"],
    "ranking_sql": ORACLE["job_ranking_sql"],
    "ranking_zero_excl": ORACLE["job_ranking_zero_excl"],
    "ranking_zero_incl": ORACLE["job_ranking_zero_incl"],
    "airport_mean": ORACLE["job_airport_mean"],
    "airport_mean_unrounded": f"""{_raw_flights(_AIRPORT_ROWS, _FLAG_OR_0)}
SELECT origin, avg({_or_zero("dep_delay")}) AS airport_mean FROM voli WHERE cancelled = 0 GROUP BY origin""",
}
_ROUTE_SHAPE = ('"Compagnia"', '"Tratta"', '"Voli"', '"Min"', '"Max"', '"Medio"', '"Cancellazioni"', "NULL", '"Mesi"')
_RANKING_SHAPE = (
    *('"Compagnia"', '"Aeroporto"', '"Voli_Operati"', '"Ritardo_Medio_Partenza"', '"Ritardo_Medio_Arrivo"'),
    *('"Differenza_Dalla_Media_APT"', '"Tasso_Cancellazione"', '"Posizione_Classifica"', "NULL"),
)
_MEAN_SHAPE = ("NULL", "origin", "NULL", "airport_mean", *["NULL"] * 5)
ORACLE["job_all_reports"] = " UNION ALL ".join(
    _one_shape(name, *(_ROUTE_SHAPE if "route" in name else _RANKING_SHAPE if "ranking" in name else _MEAN_SHAPE)) for name in _ALL_REPORTS
)
