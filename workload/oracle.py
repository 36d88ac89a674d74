"""The same questions as plain SQL for a second engine, written independently of the reports."""

from __future__ import annotations

from collections.abc import Callable

from workload import tables as t
from workload.queries import PROFILE_CATEGORIES, PROFILE_ORDER, PROFILE_RULES

ORDER_SPAN = "TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-08-01'"
EVENT_SPAN = "TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'"
WEEK_SPAN = "TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17'"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
COST = f"CAST({PRICE} * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4))"
TIME_FORMAT = "'%Y-%m-%d %H:%M:%S.%f'"
DAY_FORMAT = "'%Y-%m-%d'"
INTERVAL = "[2024-01-01→2024-01-31]"

LEVEL_COLUMNS = {
    "clinic": {"hospital_name": "n_name"},
    "dept": {"hospital_name": "n_name", "depart_name": "c_mktsegment"},
    "doctor": {"hospital_name": "n_name", "doctor_name": "c_name"},
}
STAMP = "'1995-01-01' AS period_start, '2001-08-01' AS period_end"


def _units(value: str, factor: str = "0.01") -> str:
    """Dollars to the report's currency: the tables of the reports hold hundredths of a dollar as 1/10000 units."""
    return f"round({value} * {factor}, 2)"


def _keys(short: str, grain: str) -> tuple[list[str], str]:
    """Names of the group columns, and their select list."""
    columns = dict(LEVEL_COLUMNS[short])
    if grain == "day":
        columns["pay_day"] = f"strftime(o_orderdate, {DAY_FORMAT})"
    return list(columns), ", ".join(f"{source} AS {name}" for name, source in columns.items())


def _pay_method(short: str, grain: str, exact: bool = False) -> str:
    names, select = _keys(short, grain)
    keys = ", ".join(names)
    base = "CAST(o_totalprice AS DECIMAL(18,2))"
    amounts = ", ".join(
        f"{base} * {f} AS {m}" for m, f in t.PAY_FACTORS.items()
    )
    inner = (lambda v: v) if exact else _units
    outer = _units if exact else (lambda v: v)
    stage = ", ".join(f"{inner(f'sum({m})')} AS {m}" for m in t.PAY_FACTORS)
    totals = ", ".join(f"CAST({outer(f'sum({m})')} AS DOUBLE) AS {m}" for m in t.PAY_FACTORS)
    spread = ", ".join(
        f"CAST(coalesce({outer(f'''sum(pay_amount) FILTER (WHERE method = '{value}')''')}, 0) AS DOUBLE) AS {name}"
        for value, name in t.METHODS.items()
    )
    return f"""
        WITH rows_ AS (
            SELECT {select}, o_orderpriority AS method, {amounts}
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            WHERE o_orderstatus IN ('F', 'O') AND o_orderdate BETWEEN {ORDER_SPAN}),
        staged AS (SELECT {keys}, method, {stage} FROM rows_ GROUP BY {keys}, method)
        SELECT {keys}, {totals}, {spread}, {STAMP} FROM staged GROUP BY {keys}"""


def _charge_category(short: str, grain: str) -> str:
    names, select = _keys(short, grain)
    keys = ", ".join(names)
    bases = {
        "quantity": ("CAST(l_quantity AS DECIMAL(18,2))", "0.0001"),
        "price": (PRICE, "0.01"),
        "discount": (f"{PRICE} * CAST(l_discount AS DECIMAL(18,2))", "1"),
        "tax": (f"{PRICE} * CAST(l_tax AS DECIMAL(18,2))", "1"),
    }
    sums = ", ".join(
        f"CAST({_units(f'(sum({bases[base][0]}) * {factor})', bases[base][1])} AS DOUBLE) AS {name}"
        for name, (base, factor) in t.CHARGES.items()
    )
    grouped = ", ".join(str(i + 1) for i in range(len(names)))
    return f"""
        SELECT {select}, {sums}, {STAMP}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderstatus IN ('F', 'O') AND o_orderdate BETWEEN {ORDER_SPAN}
        GROUP BY {grouped}"""


KEYS = ("hospital_name", "depart_name", "doctor_name", "pay_day")
LEVEL_NAMES = {"clinic": "clinic", "dept": "department", "doctor": "doctor"}


def _levels(one: Callable[[str, str], str]) -> str:
    """The single reports of all levels and grains, one below the other."""
    parts = []
    for short, level in LEVEL_NAMES.items():
        for grain in ("day", "period"):
            names = _keys(short, grain)[0]
            missing = ", ".join(f"NULL AS {k}" for k in KEYS if k not in names)
            parts.append(f"SELECT '{level}' AS level, '{grain}' AS grain, {missing}{', ' if missing else ''}* FROM ({one(short, grain)})")
    return " UNION ALL BY NAME ".join(parts)


def _half_up(part: str, whole: str, scale: int) -> str:
    """part / whole in units of 1/scale, in whole-number arithmetic."""
    return f"((2 * {scale} * {part} + {whole}) // (2 * {whole}))"


ROLE_COLUMNS = {"doctor": ("doctor_name", "c_mktsegment"), "consultant": ("consultants_name", "o_orderpriority")}


def _clinic_test(column: str, clinics) -> str:
    return "TRUE" if clinics is None else f"{column} IN ({', '.join(map(str, clinics))})"


def _visits(role: str, clinics=None, source: str = "main") -> str:
    urgent = "" if source == "main" else "AND o_orderpriority <> '1-URGENT'"
    name, source = ROLE_COLUMNS[role]
    rate = _half_up("r", "v", 10000)
    return f"""
        SELECT hospital_name, month, {name}, v AS visits, r AS return_visits,
               format('{{}}.{{:02d}}%', {rate} // 100, {rate} % 100) AS return_rate, p AS patients,
               CAST(CAST({_half_up("v", "p", 100)} AS DOUBLE) / 100 AS DOUBLE) AS visits_per_patient
        FROM (SELECT n_name AS hospital_name, strftime(o_orderdate, '%Y-%m') AS month, {source} AS {name},
                     count(*) AS v, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS r,
                     count(DISTINCT o_custkey) AS p
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
              WHERE o_orderdate BETWEEN {ORDER_SPAN} AND o_orderstatus IN ('F', 'O')
                AND {_clinic_test("c_nationkey", clinics)} {urgent}
              GROUP BY 1, 2, 3)"""


SHOWN = (
    "registered", "medical", "material", "instrument", "trad_medicine", "decoction",
    "west_medicine", "cp_medicine", "check", "inspect_advice", "other", "diagnosis",
)
CODE_COLUMNS = {"subject_type": "l_returnflag", "subject_id": "l_linestatus", "item_type": "l_linenumber"}


def _rule_test(rule: dict, columns: dict) -> str:
    return " AND ".join(f"{columns[c]} = {v!r}" for c, v in rule.items())


def _even(value: str) -> str:
    return f"round_even({value} * 0.1, 2)"


def _income(role: str, clinics=None, parity: bool = False, exact_type: bool = False, source: str = "main") -> str:
    name, person = ROLE_COLUMNS[role]
    charged = PRICE if source == "main" else f"(3 * {PRICE})"
    final = (lambda v, n: f"{v} AS {n}") if exact_type else (lambda v, n: f"CAST({v} AS DOUBLE) AS {n}")
    parts = []
    for category in SHOWN:
        test = _rule_test(t.RULES[category], CODE_COLUMNS)
        for suffix, value in (("fee", charged), ("cost", COST)):
            if parity and category == "other":
                value = charged
            total = _even(f"sum(CASE WHEN {test} THEN {value} ELSE 0 END)")
            parts.append(final(total, f"{category}_{suffix}"))
    price, cost = _even(f"sum({charged})"), _even(f"sum({COST})")
    return f"""
        SELECT n_name AS hospital_name, {person} AS {name}, strftime(o_orderdate, '%Y-%m') AS month,
               {', '.join(parts)}, {final(price, "total_price")}, {final(cost, "total_cost_price")},
               {final(f"({price} - {cost})", "gross_profit")}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        WHERE o_orderdate > TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-08-01'
          AND o_orderstatus <> 'P' AND {_clinic_test("c_nationkey", clinics)}
        GROUP BY 1, 2, 3"""


def _merged(role: str, clinics=None, source: str = "main", parity: bool = False) -> str:
    name, _ = ROLE_COLUMNS[role]
    values = [f"{c}_{s}" for c in SHOWN for s in ("fee", "cost")] + ["total_price", "gross_profit"]
    shown = ", ".join(f"CAST(m.{v} AS DOUBLE) AS {v}" for v in values)
    cents = "CAST(m.total_price * 100 AS HUGEINT)"
    whole, rest = f"({cents} // v.visits)", f"({cents} % v.visits)"
    up = f"CASE WHEN 2 * {rest} > v.visits OR (2 * {rest} = v.visits AND {whole} % 2 = 1) THEN 1 ELSE 0 END"
    ticket = f"CAST({whole} + {up} AS DOUBLE) / 100"
    if parity:  # the text of a float is rounded from its exact value
        ticket = "CAST(format('{:.2f}', CAST(m.total_price AS DOUBLE) / v.visits) AS DOUBLE)"
    return f"""
        SELECT v.*, {shown}, {ticket} AS average_ticket
        FROM ({_visits(role, clinics, source)}) v JOIN ({_income(role, clinics, exact_type=True, source=source)}) m
          ON v.hospital_name = m.hospital_name AND v.{name} = m.{name} AND v.month = m.month"""


def _two_sources(role: str) -> str:
    return " UNION ALL ".join(f"({_merged(role, clinics, source)})" for source, clinics in t.CLINICS.items())


ORDER_STATE = "CASE l_returnflag WHEN 'A' THEN 'waiting' WHEN 'N' THEN 'answered' ELSE '###' END"
PAY_STATE = "CASE l_linestatus WHEN 'F' THEN 'paid' ELSE '###' END"
AMOUNT = f"round({PRICE} * 0.01, 2)"
SHIPPED = f"strftime(l_shipdate, {TIME_FORMAT})"

INQUIRY_ROWS = f"""
    SELECT l_orderkey AS inquiry_ord_id, CASE WHEN l_linenumber = 1 THEN 'text' ELSE 'phone' END AS inquiry_type,
           p_name AS user_name, p_brand AS bill_id, 'doctor ' || l_suppkey AS doctor_name, s_name AS doctor_phone,
           CAST(s_nationkey AS VARCHAR) AS department, {AMOUNT} AS amount,
           {SHIPPED} AS create_date, {ORDER_STATE} AS ord_state, {PAY_STATE} AS pay_state,
           CASE WHEN l_discount > 0 THEN 'abnormal' ELSE 'normal' END AS abnormal_state
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    WHERE s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
      AND l_shipdate > TIMESTAMP '1995-01-02' AND l_shipdate <= TIMESTAMP '2001-11-01'"""
ONLINE_ROWS = f"""
    SELECT l_orderkey AS inquiry_ord_id, {SHIPPED} AS create_date, l_linenumber AS medical_ord_id,
           'patient ' || l_partkey AS user_name, CAST(s_nationkey AS VARCHAR) AS department, p_brand AS bill_id,
           'doctor ' || l_suppkey AS doctor_name, {AMOUNT} AS amount,
           {ORDER_STATE} AS ord_state, {PAY_STATE} AS pay_state, {SHIPPED} AS pay_date
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)
      AND l_shipdate > TIMESTAMP '1995-01-02' AND l_shipdate < TIMESTAMP '2001-11-01'"""


def _order_list(rows: str) -> str:
    return f"SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM ({rows})"


def _order_sum(rows: str, group: str) -> str:
    return f"SELECT {group}, CAST(sum(amount) AS DOUBLE) AS total_amount FROM ({rows}) GROUP BY {group}"


def _activity(parity: bool) -> str:
    link = "follow.doctor_id" if parity else "c_custkey"
    inside = f"CASE WHEN ts BETWEEN {WEEK_SPAN} THEN 1 END"
    return f"""
        SELECT c_name AS doctor_name, n_name AS referrer_name, c_mktsegment AS medical_institution,
               CAST(c_nationkey AS VARCHAR) AS department, coalesce(followers, 0) AS followers,
               coalesce(registrations, 0) AS registrations,
               '2024-01-10' AS period_start, '2024-01-17' AS period_end,
               coalesce(new_followers, 0) AS new_followers, coalesce(new_registrations, 0) AS new_registrations,
               coalesce(new_inquiries, 0) AS new_inquiries, coalesce(new_prescriptions, 0) AS new_prescriptions,
               coalesce(online_paid, 0) AS online_paid, coalesce(offline_paid, 0) AS offline_paid
        FROM customer
        LEFT JOIN (SELECT user_id AS doctor_id, count(DISTINCT floor("value")) AS followers,
                          count({inside}) AS new_followers
                   FROM events WHERE event_type = 'view' AND "value" >= 100 GROUP BY 1) follow
          ON c_custkey = follow.doctor_id
        LEFT JOIN (SELECT user_id AS doctor_id, count(DISTINCT floor("value")) AS registrations,
                          count({inside}) AS new_registrations
                   FROM events WHERE event_type = 'signup' AND "value" >= 5 GROUP BY 1) reg
          ON reg.doctor_id = {link}
        LEFT JOIN (SELECT user_id AS doctor_id, count(*) AS new_inquiries
                   FROM events WHERE event_type = 'click' AND ts BETWEEN {WEEK_SPAN} GROUP BY 1) inq
          ON inq.doctor_id = {link}
        LEFT JOIN (SELECT user_id AS doctor_id, count(*) AS new_prescriptions,
                          count(CASE WHEN "value" >= 60 THEN 1 END) AS online_paid,
                          count(CASE WHEN "value" >= 10 AND "value" < 60 THEN 1 END) AS offline_paid
                   FROM events WHERE event_type = 'purchase' AND ts BETWEEN {WEEK_SPAN} GROUP BY 1) rx
          ON rx.doctor_id = {link}
        LEFT JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
          AND n_name LIKE '%NATION%'"""


VALID_EVENTS = f"SELECT * FROM events WHERE event_type <> 'error' AND ts BETWEEN {EVENT_SPAN}"
NTH = f"""
    SELECT c_name AS doctor_name, c_custkey AS doctor_id, n AS registrations,
           strftime(ts, {TIME_FORMAT}) AS reached_at, 55 AS threshold, '{INTERVAL}' AS interval
    FROM (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k,
                 count(*) OVER (PARTITION BY user_id) AS n FROM ({VALID_EVENTS}))
    JOIN customer ON user_id = c_custkey WHERE k = 55"""


def _profile() -> str:
    codes = {c: c for c in ("l_returnflag", "l_linestatus", "l_linenumber")}
    parts = []
    for category in PROFILE_CATEGORIES:
        test = _rule_test(PROFILE_RULES[category], codes)
        fee, cost = (f"round(sum(CASE WHEN {test} THEN {v} ELSE 0 END), 2)" for v in (PRICE, COST))
        parts += [f"{fee} AS {category}_fee", f"{cost} AS {category}_cost", f"{fee} - {cost} AS {category}_profit"]
    return f"""
        SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
               n_name AS clinic, {', '.join(parts)}, round(sum({PRICE}), 2) AS income,
               round(sum({COST}), 2) AS cost, round(sum({PRICE}), 2) - round(sum({COST}), 2) AS profit
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        GROUP BY 1, 2, 3"""


PROFILE_KEYS = ("year", "month", "clinic")


def _profile_reorder() -> str:
    shown = ", ".join(c if c in PROFILE_KEYS else f"CAST({c} AS DOUBLE) AS {c}" for c in PROFILE_ORDER)
    return f"SELECT {shown} FROM ({_profile()})"


def _profile_row() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({c if c in PROFILE_KEYS else f'CAST({c} AS DECIMAL(28,2))'} AS VARCHAR) AS value "
        "FROM head"
        for c in PROFILE_ORDER
    )
    return f"WITH head AS (SELECT * FROM ({_profile()}) ORDER BY year, month, clinic LIMIT 1) {rows}"


def _pivot_from_file() -> str:
    price = "CAST(o_totalprice AS DECIMAL(18,2))"
    spread = ", ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{value}' THEN {price} ELSE 0 END) AS DOUBLE) AS {name}"
        for value, name in t.METHODS.items()
    )
    return f"""
        SELECT n_name AS hospital_name, CAST(sum({price}) AS DOUBLE) AS pay_amount, {spread}
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1"""


CHAR_MODE = """
    WITH chars AS (
        SELECT doc_id, unnest(string_split(text, '')) AS char,
               unnest(range(len(string_split(text, '')))) AS place
        FROM documents),
    counted AS (
        SELECT doc_id, char, count(*) AS n, min(place) AS first_place,
               string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) AS positions
        FROM chars GROUP BY doc_id, char)
    SELECT doc_id, char, n, positions
    FROM counted
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_place) = 1"""


def _label(column: str, labels: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + " ELSE '###' END"


_DATE_TEXT = "year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)"
_WELL_FORMED = "month(o_orderdate) >= 10 AND day(o_orderdate) >= 10"


def _day(expression: str) -> str:
    return f"strftime({expression}, {DAY_FORMAT})"


def oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for short in LEVEL_COLUMNS:
        for grain in ("day", "period"):
            found[f"pay_method_{short}_{grain}"] = _pay_method(short, grain)
            found[f"charge_category_{short}_{grain}"] = _charge_category(short, grain)
    for short, grain in (("clinic", "period"), ("dept", "day")):
        whole = _pay_method(short, grain).replace(STAMP, STAMP.replace("'2001-08-01'", "'2001-08-01 23:59:59'"))
        found[f"pay_method_kept_{short}_{grain}"] = whole.replace(ORDER_SPAN, "TIMESTAMP '1995-01-01' AND TIMESTAMP '2001-08-01 23:59:59'")
    found["charge_category_bucketed"] = _charge_category("clinic", "day")
    found["income_cost_bucketed"] = _income("doctor")
    patients = """SELECT n_name AS hospital_name, strftime(o_orderdate, '%Y-%m') AS month, o_custkey AS id
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderstatus IN ('F', 'O') AND o_orderdate BETWEEN """ + ORDER_SPAN
    found["distinct_patients"] = " UNION ALL ".join(
        f"SELECT '{level}' AS level, {clinic} AS hospital_name, {month} AS month, count(DISTINCT id) AS patients, {STAMP} FROM ({patients}) {group}"
        for level, clinic, month, group in (
            ("clinic month", "hospital_name", "month", "GROUP BY hospital_name, month"),
            ("clinic", "hospital_name", "NULL", "GROUP BY hospital_name"),
            ("month", "NULL", "month", "GROUP BY month"),
            ("all", "NULL", "NULL", ""),
        )
    )
    kinds = {
        "o_orderkey": "long", "o_custkey": "long", "o_orderstatus": "string", "o_totalprice": "decimal", "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string", "part_of_hundred": "long", "day": "date", "code": "string", "even": "boolean",
    }
    found["inferred_orders"] = f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, {TIME_FORMAT}) AS o_orderdate, o_orderpriority,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 100 END AS part_of_hundred, strftime(o_orderdate, {DAY_FORMAT}) AS day,
            lpad(CAST(o_custkey % 1000 AS VARCHAR), 4, '0') AS code, o_orderkey % 2 = 0 AS even,
            '{", ".join(f"{c} {k}" for c, k in kinds.items())}' AS kinds
        FROM orders"""
    found["pay_method_levels"] = _levels(_pay_method)
    found["charge_category_levels"] = _levels(_charge_category)
    found["pay_method_clinic_period_exact"] = _pay_method("clinic", "period", exact=True)
    for role in ROLE_COLUMNS:
        suffix = "" if role == "doctor" else f"_{role}"
        found[f"visit_indicators_{role}"] = _visits(role)
        found[f"income_cost_{role}"] = _income(role)
        found[f"merged_summary{suffix}"] = _merged(role)
        found[f"merged_two_sources{suffix}"] = _two_sources(role)
    found["income_cost_parity"] = _income("doctor", parity=True)
    found["merged_summary_parity"] = _merged("doctor", parity=True)
    found["doctor_activity"] = _activity(parity=False)
    found["doctor_activity_parity"] = _activity(parity=True)
    found["inquiry_orders"] = _order_list(INQUIRY_ROWS)
    found["inquiry_orders_sum"] = _order_sum(INQUIRY_ROWS, "doctor_name, user_name, inquiry_type, pay_state")
    found["online_orders"] = _order_list(ONLINE_ROWS)
    found["online_orders_sum"] = _order_sum(ONLINE_ROWS, "doctor_name, user_name, pay_state")
    found["in_list"] = """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
            SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'))"""
    found["not_in_list"] = """
        SELECT c_custkey, c_name FROM customer
        WHERE c_custkey NOT IN (
            SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"""
    found["registration_counts"] = f"""
        SELECT c_name AS doctor_name, c_custkey AS doctor_id, count(*) AS registrations, '{INTERVAL}' AS interval
        FROM ({VALID_EVENTS}) JOIN customer ON user_id = c_custkey GROUP BY 1, 2"""
    found["nth_registration"] = NTH
    found["nth_event_large"] = f"""
        SELECT event_type, strftime(ts, {TIME_FORMAT}) AS ts FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts) = 1500"""
    found["registration_detail"] = f"""
        SELECT c_name AS doctor_name, p_name AS user_name, CASE WHEN p_size <= 25 THEN '男' ELSE '女' END AS sex,
               p_brand AS bill_id, strftime(ts, {TIME_FORMAT}) AS registered_at
        FROM events JOIN part ON p_partkey = CAST(floor("value") AS BIGINT)
        LEFT JOIN customer ON user_id = c_custkey
        WHERE ts BETWEEN {EVENT_SPAN} AND user_id IN (SELECT doctor_id FROM ({NTH}))"""
    found["dense_nth_registration"] = f"""
        SELECT doctor_name, 25 AS threshold, strftime(d, {TIME_FORMAT}) AS reached_at,
               '2024-01-01→2024-01-31' AS interval
        FROM (SELECT c_name AS doctor_name, date_trunc('day', ts) AS d,
                     dense_rank() OVER (PARTITION BY c_name ORDER BY date_trunc('day', ts)) AS k
              FROM events JOIN customer ON user_id = c_custkey
              WHERE date_trunc('day', ts) BETWEEN {EVENT_SPAN} AND user_id IN (
                  SELECT user_id FROM events WHERE event_type IN ('click', 'signup')
                    AND date_trunc('day', ts) BETWEEN {EVENT_SPAN} GROUP BY user_id HAVING count(*) >= 25))
        WHERE k = 25"""
    found["dense_nth_large"] = f"""
        SELECT event_type, strftime(minute, {TIME_FORMAT}) AS ts, ties FROM (
            SELECT event_type, date_trunc('minute', ts) AS minute, count(*) AS ties FROM events GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY minute) = 1200"""
    found["exclude_by_words"] = """
        SELECT p_partkey, p_name, p_type FROM part
        WHERE NOT (regexp_matches(p_name, 'red|bolt') OR regexp_matches(p_type, 'ECONOMY|SMALL'))"""
    found["profile_reorder"] = _profile_reorder()
    found["profile_row_unpivot"] = _profile_row()
    found["pivot_from_file"] = _pivot_from_file()
    found["char_mode_positions"] = CHAR_MODE
    found["top_k_priority"] = """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""
    found["top_k_per_group"] = """
        SELECT * FROM (
            SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders)
        WHERE rank <= 3"""
    found["top_k_per_group_large"] = """
        SELECT * FROM (
            SELECT o_orderstatus, o_orderkey, o_totalprice, CAST(row_number() OVER (
                PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders)
        WHERE rank <= 1500"""
    monday = "CAST(o_orderdate AS DATE) - CAST(isodow(o_orderdate) - 1 AS INTEGER)"
    found["calendar_bounds"] = f"""
        SELECT o_orderkey, {_day("o_orderdate")} AS day, strftime(o_orderdate, '%Y-%m') AS month,
               strftime(o_orderdate, '%m') AS month_number, {_day("date_trunc('month', o_orderdate)")} AS month_first,
               {_day("last_day(o_orderdate)")} AS month_last, {_day("o_orderdate + INTERVAL 7 DAY")} AS in_a_week,
               {_day(monday)} AS monday, {_day(f"{monday} + 6")} AS sunday, {_day(monday)} AS week_first,
               {_day("date_trunc('year', o_orderdate)")} AS year_first,
               strftime(o_orderdate, {TIME_FORMAT}) AS midnight, strftime(o_orderdate, '%H:%M:%S') AS clock
        FROM orders"""
    found["label_decode"] = f"""
        SELECT o_orderkey, {_label("o_orderpriority", t.METHODS)} AS method,
               {_label("o_orderstatus", {"F": "finished", "O": "open"})} AS state,
               CASE WHEN o_orderstatus = 'F' THEN 'finished' ELSE 'not finished' END AS two_way
        FROM orders"""
    found["bad_date_rows"] = f"""
        SELECT o_orderkey, {_DATE_TEXT} AS date_text,
               CASE WHEN {_WELL_FORMED} THEN {_day("o_orderdate")} ELSE '-' END AS date,
               CASE WHEN {_WELL_FORMED} THEN 'good' ELSE 'bad' END AS verdict
        FROM orders"""
    found["missing_column_union"] = """
        SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(0 AS DOUBLE) AS balance, 0 AS visits
        FROM customer
        UNION ALL SELECT s_suppkey, s_name, '0', CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE), 0 FROM supplier"""
    wide = """
        SELECT c_custkey, c_mktsegment, s_name, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
               s_nationkey
        FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
    found["null_fill_drop"] = f"""
        WITH wide AS ({wide})
        SELECT c_custkey, c_mktsegment, coalesce(s_name, '?') AS s_name, coalesce(balance, 0) AS balance,
               coalesce(s_nationkey, 0) AS s_nationkey, 'numbers' AS rule FROM wide
        UNION ALL SELECT c_custkey, c_mktsegment, coalesce(s_name, 'none'), coalesce(balance, 1),
               coalesce(s_nationkey, -1), 'one_column' FROM wide
        UNION ALL SELECT *, 'complete' FROM wide WHERE s_name IS NOT NULL"""
    return found
