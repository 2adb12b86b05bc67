"""SQL equivalents of the registered queries, for DuckDB on the same tables.

Money is computed on exact decimals or whole cents and turned into DOUBLE at the
very end, as the queries do."""

from __future__ import annotations

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def cents(c: str) -> str:
    return f"CAST({c} AS DECIMAL(18,2))"


def whole(c: str) -> str:
    """A two-decimal double as whole cents."""
    return f"CAST({cents(c)} * 100 AS HUGEINT)"


def cents_text(c: str) -> str:
    return f"CAST({cents(c)} AS VARCHAR)"


def txt(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def month(c: str) -> str:
    return f"strftime({c}, '%Y-%m')"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def key(c: str) -> str:
    return f"lower({strip(f'coalesce({c}, {chr(39) * 2})')})"


def case(c: str, values: dict, default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} = '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


def parse(c: str) -> str:
    return f"coalesce(TRY_CAST(regexp_replace({c}, '[^0-9.-]', '', 'g') AS DECIMAL(30,10)), 0)"


def lenient(c: str) -> str:
    return f"coalesce(TRY_CAST({strip(c)} AS DECIMAL(30,10)), 0)"


def detect(c: str) -> str:
    markers = [("R$", "BRL"), ("€", "EUR"), ("£", "GBP"), ("COP", "COP"), ("MXN", "MXN"), ("PEN", "PEN"),
               ("ARS", "ARS"), ("CLP", "CLP"), ("USD", "USD"), ("$", "USD")]
    return "CASE " + " ".join(f"WHEN contains({c}, '{m}') THEN '{k}'" for m, k in markers) + " END"


def half_up(numerator: str, denominator: str) -> str:
    """Whole-number quotient rounded half away from zero; null for a zero divisor."""
    n, d = f"({numerator})", f"({denominator})"
    return (f"CASE WHEN {d} <> 0 THEN sign({n}) * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END")


def money(cents_value: str) -> str:
    """Whole cents as DOUBLE."""
    return f"CAST({cents_value} AS DOUBLE) / 100"


def money_text(cents_value: str) -> str:
    """Whole cents as decimal text; null as ''."""
    return f"coalesce(CAST(CAST(CAST({cents_value} AS DECIMAL(38,0)) / 100 AS DECIMAL(20,2)) AS VARCHAR), '')"


ACCOUNTS = """accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_mktsegment AS platform, n_name AS operator,
         r_name AS brand, c_name AS username, c_custkey, c_nationkey, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

DAY_RATES = f"""rates AS (
  SELECT strftime(ts, '%d') AS month, event_type AS currency,
         arg_min({whole('value')}, (strftime(ts, '%Y-%m-%d %H:%M:%S'), 'EUR', {cents_text('value')})) AS cents
  FROM events GROUP BY ALL)"""

ORDER_CURRENCY = case("o_orderpriority", {"1-URGENT": "'purchase'", "2-HIGH": "'signup'", "3-MEDIUM": "'view'",
                                          "4-NOT SPECIFIED": "'click'"}, "'none'")
ORDER_AMOUNTS = f"""amounts AS (
  SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%d') AS month, {ORDER_CURRENCY} AS currency,
         o_orderstatus, {whole('o_totalprice')} AS cents FROM orders)"""

LOGIN = """CASE c_mktsegment WHEN 'BUILDING' THEN c_name || '@GMail.com'
  WHEN 'MACHINERY' THEN ' ' || c_name || '@mail.example.com ' ELSE c_name END"""
SHEET_LOGIN = """CASE c_mktsegment WHEN 'BUILDING' THEN c_name || '_north' WHEN 'MACHINERY' THEN 'EU_' || c_name
  WHEN 'FURNITURE' THEN 'x_' || c_name || '_y_z' WHEN 'HOUSEHOLD' THEN c_name || 'north' ELSE c_name END"""

CELL_A = case("o_orderpriority", {"1-URGENT": "'R$'", "2-HIGH": "'€'"}, "''") + f" || {cents_text('o_totalprice')}"
CELL_B = case("o_orderstatus", {"O": "'$'", "F": "'MXN '"}, "''") + f" || {txt('o_orderkey')}"
SYMBOL_CELLS = f"cells AS (SELECT o_orderkey, o_custkey, o_orderdate, {CELL_A} AS cell_a, {CELL_B} AS cell_b FROM orders)"

COMMISSION = f"""commissions AS (
  SELECT user_id, strftime(ts, '%d') AS month, CASE WHEN event_type <> 'error' OR value > 50 THEN
         {case('event_type', {'purchase': "'CPA (x)'", 'signup': "' cpa y'", 'view': "'Revshare Ongoing'",
                              'click': "'RevShare z '", 'error': "'Fee'"})} END AS commission_type,
         {cents('value')} AS amount FROM events)"""

CONDITIONAL = f"""sums AS (
  SELECT user_id, month,
         sum(CASE WHEN {key('commission_type')} LIKE 'cpa%' THEN amount ELSE 0 END) AS cpa,
         sum(CASE WHEN {key('commission_type')} LIKE 'revshare%' THEN amount ELSE 0 END) AS rs
  FROM commissions GROUP BY ALL)"""

REFERENCE = """refs AS (
  SELECT lower(operator) AS k, lower(username) AS u, lower(brand) AS b,
         CASE WHEN platform <> 'FURNITURE' THEN 'REF ' || account_id END AS ref,
         CASE WHEN c_acctbal < 1000 THEN 'No' WHEN c_acctbal < 5000 THEN 'Sí' ELSE 'No' END AS netting
  FROM accounts)"""

UNION_ROWS = """union_rows AS (
  SELECT o_orderkey, account_id, platform, operator, brand, username
  FROM orders JOIN accounts ON CAST(o_custkey AS VARCHAR) = account_id)"""

SHEET = f"""sheet AS (
  SELECT 'b' AS brand, CASE WHEN o_orderstatus = 'P' THEN 'Other' ELSE ' Wide ' END AS platform,
         {txt('o_custkey')} AS username, o_orderstatus AS ref,
         {case('o_orderpriority', {'1-URGENT': "'CPA'", '2-HIGH': "' rs'", '3-MEDIUM': "'cpa '"}, "'Fijo'")} AS commission,
         CASE WHEN o_totalprice < 100000 THEN '' WHEN o_totalprice < 250000 THEN 'Sí' ELSE 'No' END AS netting,
         o_orderkey AS pos FROM orders)"""
PREFERRED = """preferred AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY brand, username, ref
             ORDER BY CASE lower(trim(commission)) WHEN 'rs' THEN 0 ELSE 1 END, pos) AS rn
    FROM sheet WHERE lower(trim(platform)) = 'wide' AND lower(trim(commission)) IN ('rs', 'cpa')) WHERE rn = 1)"""

STORED = f"""stored AS (
  SELECT o_custkey, CASE year(o_orderdate) WHEN 1995 THEN strftime(o_orderdate, '%m') WHEN 1996 THEN NULL
         ELSE {month('o_orderdate')} END AS month, o_orderkey, o_orderstatus, {cents('o_totalprice')} AS amount
  FROM orders)"""

WIDE = f"""wide AS (
  SELECT o_orderpriority AS operator, o_orderstatus AS brand, {txt('o_custkey')} AS username,
         {month('o_orderdate')} AS month, {cents('o_totalprice')} AS price, o_orderkey
  FROM orders WHERE o_orderstatus <> 'P')"""

VENDOR = f"""vendor AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'Openbet' ELSE 'Closedbet' END AS operator,
         CASE WHEN l_returnflag = 'R' THEN 'Brand R' ELSE 'Brand X' END AS brand, {txt('l_orderkey')} AS username,
         {month('l_shipdate')} AS month, CASE WHEN l_returnflag = 'A' THEN 'EUR' ELSE 'BRL' END AS currency,
         s_name, {cents('l_extendedprice')} AS rs, {cents('l_quantity')} AS cpa
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

STEPS = f"""steps AS (
  SELECT {month('o_orderdate')} AS month, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN -1 ELSE 3 END AS rc,
         {whole('o_totalprice')} AS deci FROM orders)"""


def hms(seconds: str) -> str:
    return (f"format('{{:02d}}:{{:02d}}:{{:02d}}', CAST({seconds} // 3600 AS BIGINT), "
            f"CAST({seconds} % 3600 // 60 AS BIGINT), CAST({seconds} % 60 AS BIGINT))")


# seconds = cents / 1000 (a tenth of the price), rounded half to even
STEP_SECONDS = ("CAST(deci // 1000 + CASE WHEN deci % 1000 > 500 OR (deci % 1000 = 500 AND deci // 1000 % 2 = 1) "
                "THEN 1 ELSE 0 END AS BIGINT)")
STEP_SECONDS_UP = "CAST((deci + 500) // 1000 AS BIGINT)"

ORACLE: dict[str, str] = {}

ORACLE["parse_money"] = f"""
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' ELSE
    {case('o_orderpriority', {'1-URGENT': "'R$'", '2-HIGH': "'€'", '3-MEDIUM': "'USD '", '4-NOT SPECIFIED': "''"})}
    || CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '' END || format('{{:,.2f}}', o_totalprice) END AS money_text
  FROM orders)
SELECT o_orderkey, money_text, CAST({parse('money_text')} AS DOUBLE) AS amount,
       CAST({lenient('money_text')} AS DOUBLE) AS lenient,
       CAST({lenient("replace(money_text, ',', '')")} AS DOUBLE) AS plain FROM t"""

ORACLE["detect_currency_rows"] = f"""
WITH {SYMBOL_CELLS}
SELECT o_orderkey, {detect('cell_a')} AS code_a, coalesce({detect('cell_a')}, {detect('cell_b')}) AS row_code FROM cells"""

ORACLE["table_currency_scan"] = f"""
WITH {SYMBOL_CELLS}, flat AS (
  SELECT o_custkey, 0 AS c, o_orderkey AS r, {detect('cell_b')} AS code FROM cells
  UNION ALL SELECT o_custkey, 1, o_orderkey, {detect('cell_a')} FROM cells)
SELECT o_custkey, arg_min(code, (c, r)) FILTER (code IS NOT NULL) AS currency FROM flat GROUP BY o_custkey"""

ORACLE["first_currency"] = f"""
WITH {SYMBOL_CELLS}, t AS (
  SELECT o_custkey, {month('o_orderdate')} AS month, day(o_orderdate) AS r, {detect('cell_a')} AS a, {detect('cell_b')} AS b
  FROM cells)
SELECT o_custkey, month, coalesce(arg_min(a, (r, a)) FILTER (a IS NOT NULL),
                                  arg_min(b, (r, b)) FILTER (b IS NOT NULL)) AS currency
FROM t GROUP BY ALL"""

ORACLE["merchant_usernames"] = """
SELECT c_custkey, CASE WHEN p_type <> 'ECONOMY' THEN string_split(p_name, ' ')[-1] || '_' || c_name ELSE c_name END
  AS account_username
FROM customer LEFT JOIN part ON c_custkey = p_partkey"""

ORACLE["normalize_keys"] = """
SELECT doc_id, lower(source) || ' ' || lower(lang) AS key, lower(source) || lower(lang) AS platform,
       CASE source WHEN 'src0' THEN 'Source Zero' WHEN 'src1' THEN 'Source One' ELSE upper(source) END AS operator,
       source || '___' || lang AS file_name, upper(source) || '_' || upper(lang) AS token FROM documents"""

ORACLE["login_names"] = f"""
WITH t AS (SELECT c_custkey, c_name, trim({LOGIN}) AS login, {SHEET_LOGIN} AS sheet FROM customer)
SELECT c_custkey, CASE WHEN NOT contains(login, '@') THEN login
         WHEN lower(split_part(split_part(login, '@', 2), '.', 1)) = 'gmail' THEN split_part(login, '@', 1)
         ELSE split_part(login, '@', 1) || split_part(split_part(login, '@', 2), '.', 1) END AS login,
       contains('_' || sheet || '_', '_' || c_name || '_') AS is_base,
       contains('_' || c_name || '_', '_' || sheet || '_') AS is_base_reversed FROM t"""

ORACLE["base_urls"] = """
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS base_url FROM pages"""

ORACLE["period_filter"] = f"""
WITH t AS (SELECT o_orderkey, {month('o_orderdate')} AS row_month,
  {month("date_trunc('month', o_orderdate + INTERVAL 20 DAY) - INTERVAL 1 DAY")} AS period FROM orders)
SELECT o_orderkey, row_month, period, true AS is_label, false AS is_label_day FROM t WHERE row_month = period"""

ORACLE["target_month"] = f"""
SELECT o_orderkey, {month('o_orderdate')} AS month, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-05-01' AND o_orderdate < TIMESTAMP '1998-06-01'"""

ORACLE["account_filters"] = f"""
WITH {ACCOUNTS}, a AS (
  SELECT account_id, platform, operator, CASE WHEN c_acctbal < 0 THEN '0' WHEN c_acctbal < 2000 THEN ' 1 '
         WHEN c_acctbal < 4000 THEN '3' WHEN c_acctbal < 7000 THEN '4' ELSE '5' END AS active
  FROM accounts WHERE c_nationkey <> 3)
SELECT 'active' AS selection, account_id, active FROM a WHERE platform = 'BUILDING' AND trim(active) = '1'
UNION ALL SELECT 'with_inactive', account_id, active FROM a WHERE platform = 'MACHINERY' AND trim(active) IN ('1', '4', '5')
UNION ALL SELECT 'one_operator', account_id, active FROM a
  WHERE platform = 'FURNITURE' AND operator = 'NATION_8' AND trim(active) <> '0'
UNION ALL SELECT 'by_ids', account_id, active FROM a WHERE platform = 'HOUSEHOLD' AND trim(active) IN ('1', '4', '5')
  AND account_id IN (SELECT {txt('o_custkey')} FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)"""

ORACLE["tag_accounts"] = f"""
WITH {ACCOUNTS}
SELECT account_id, platform, operator, brand, username, {month('o_orderdate')} AS month,
       CASE WHEN o_orderkey > 100 THEN 'EUR' ELSE '' END AS currency, o_orderkey, {month('o_orderdate')} AS row_month
FROM orders JOIN accounts ON o_custkey = c_custkey"""

TAGS = "account_id, platform, operator, brand, username"

ORACLE["standard_wide"] = f"""
WITH {ACCOUNTS}, {SYMBOL_CELLS}
SELECT {TAGS}, '2000-01' AS month, coalesce({detect('cell_a')}, {detect('cell_b')}, '') AS currency, {month('orders.o_orderdate')} AS row_month,
       cell_a AS rs_reward, cell_b AS cpa_reward, {cents_text('o_totalprice')} AS reward_due
FROM orders JOIN cells USING (o_orderkey) JOIN accounts ON orders.o_custkey = c_custkey WHERE o_orderpriority <> '5-LOW'"""

ORACLE["standard_multilingual"] = f"""
WITH {ACCOUNTS}
SELECT account_id, platform, operator, brand, CASE WHEN c_acctbal < 9000 AND c_nationkey > 4 THEN platform || '_' || username
       WHEN c_acctbal >= 9000 THEN '0_' || username ELSE username END AS account_username, '2000-01' AS month,
       CASE WHEN c_acctbal < 9000 THEN ' 1' ELSE '1' END AS rowid,
       CASE WHEN c_acctbal >= 9000 THEN '0' WHEN c_nationkey < 9 THEN '€' END AS currency,
       CASE WHEN c_acctbal < 9000 THEN {cents_text('c_acctbal')} ELSE '0' END AS pct_commission,
       CASE WHEN c_acctbal < 9000 THEN {txt('c_nationkey')} ELSE '0' END AS cpa_commission
FROM accounts WHERE c_acctbal >= 0"""

ORACLE["standard_long"] = f"""
WITH {ACCOUNTS}, {SYMBOL_CELLS}, shown AS (
  SELECT o_custkey, arg_min({detect('cell_b')}, o_orderkey) FILTER ({detect('cell_b')} IS NOT NULL AND o_orderkey % 2 <> 0) AS a,
         arg_min({detect('cell_b')}, o_orderkey) FILTER ({detect('cell_b')} IS NOT NULL AND o_orderkey % 2 = 0) AS b FROM cells GROUP BY 1),
sums AS (SELECT user_id AS id, event_type AS commission_type, CAST(sum({cents('value')}) AS DOUBLE) AS amount FROM events GROUP BY ALL
  UNION ALL SELECT c_custkey, unnest(['CPA', 'Revshare Ongoing PL']), 0.0::DOUBLE FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))
SELECT {TAGS}, '2000-01' AS month, coalesce(a, b, '') AS currency, commission_type, amount
FROM sums JOIN accounts ON id = c_custkey LEFT JOIN shown ON id = o_custkey"""

ORACLE["standard_vendor"] = f"""
WITH {ACCOUNTS}, {SYMBOL_CELLS}, own AS (
  SELECT o_custkey, arg_min({detect('cell_a')}, o_orderkey) FILTER ({detect('cell_a')} IS NOT NULL) AS a,
         arg_min({detect('cell_b')}, o_orderkey) FILTER ({detect('cell_b')} IS NOT NULL) AS b FROM cells GROUP BY 1)
SELECT {TAGS}, '2000-01' AS month, CASE WHEN c_nationkey < 9 THEN 'GBP' ELSE coalesce(a, b, '') END AS currency, 'V' AS vendor_name,
       cell_a AS revshare_commission, cell_b AS cpa_commission
FROM cells JOIN accounts ON o_custkey = c_custkey LEFT JOIN own USING (o_custkey)"""

ORACLE["brand_slice"] = f"""
WITH {ACCOUNTS} SELECT account_id, platform, operator, brand FROM accounts WHERE brand = 'EUROPE'"""

ORACLE["drop_totals_rows"] = f"""
SELECT {txt('o_orderkey')} AS item, ' 1' AS rowid, o_custkey, o_totalprice AS amount FROM orders"""

ORACLE["header_canonicalise"] = f"""
SELECT {txt('o_orderkey')} AS rowid, o_orderpriority AS currency,
       CASE o_orderstatus WHEN 'F' THEN {cents_text('o_totalprice')} WHEN 'O' THEN 'x' END AS net_revenue,
       {cents_text('o_totalprice')} AS cpa_commission, {txt('o_custkey')} AS affiliate_id,
       o_orderstatus AS "Custom Field" FROM orders"""

ORACLE["rejected_values"] = f"""
WITH t AS (SELECT {txt('o_orderkey')} AS o_orderkey, o_custkey % 40 + 1 AS n, repeat('9', (o_custkey % 40 + 1)::INT) AS nines, o_custkey % 12 AS z, o_orderstatus = 'F' AS f, o_orderpriority = '5-LOW' AS low FROM orders),
v AS (SELECT *, CASE WHEN f THEN '€-' ELSE 'R$' END || nines || '.50' AS money, CASE WHEN low THEN nines ELSE 'x9' END AS plain,
             CASE WHEN f THEN '0.' || repeat('0', z::INT) || '1' ELSE ' ' || nines END AS rate,
             CASE WHEN f AND z >= 8 THEN 'too small' WHEN NOT f AND n > 20 THEN 'too large' END AS rate_reason FROM t)
SELECT o_orderkey, 'money' AS "column", money AS value, 'too large' AS reason FROM v WHERE n > 28
UNION ALL SELECT o_orderkey, 'plain', plain, 'too large' FROM v WHERE low AND n > 28
UNION ALL SELECT o_orderkey, 'rate', rate, rate_reason FROM v WHERE rate_reason IS NOT NULL
UNION ALL SELECT o_orderkey, '', money, 'good' FROM v WHERE n <= 28 AND rate_reason IS NULL"""

ORACLE["record_cells_split"] = f"""
SELECT p_partkey, CAST(6 + p_partkey % 400 AS INTEGER) AS n_cells, {txt('p_partkey')} AS cell_0,
       p_name || ', "' || p_type || '"' || chr(10) AS cell_1, CAST(NULL AS VARCHAR) AS cell_2, CAST(NULL AS VARCHAR) AS cell_3, p_type AS last_cell FROM part"""

ORACLE["landed_layouts"] = f"""
SELECT {txt('o_orderkey')} AS account_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderstatus END AS "Custom",
       CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN CASE WHEN o_orderstatus = 'F' THEN {cents_text('o_totalprice')} ELSE {txt('o_custkey')} END END AS cpa_commission,
       CASE WHEN o_orderpriority = '2-HIGH' THEN {txt('o_custkey')} END AS custom__3,
       CASE WHEN o_orderpriority = '2-HIGH' THEN {cents_text('o_totalprice')} WHEN o_orderpriority = '1-URGENT' THEN CASE o_orderstatus WHEN 'F' THEN {cents_text('o_totalprice')} WHEN 'O' THEN 'x' END END AS net_revenue,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN {txt('o_orderkey')} END AS rowid FROM orders"""

ORACLE["ranked_sources"] = f"""
WITH files AS (SELECT {txt('o_custkey')} AS account_id, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS source, {txt('o_orderkey')} AS file_name FROM orders)
SELECT account_id, CAST(source AS INTEGER) AS source, file_name FROM files QUALIFY source = min(source) OVER (PARTITION BY account_id)"""

ORACLE["conditional_sums"] = f"""
WITH {COMMISSION}, {CONDITIONAL}
SELECT user_id, month, CAST(cpa AS DOUBLE) AS cpa_amount, CAST(rs AS DOUBLE) AS rs_amount FROM sums"""

ORACLE["sum_by_type"] = f"""
WITH {COMMISSION}
SELECT {txt('user_id')} AS account_id, coalesce(trim(commission_type), '') AS commission_type,
       CAST(sum(amount) AS DOUBLE) AS amount FROM commissions GROUP BY user_id, commission_type
UNION ALL
SELECT {txt('c_custkey')}, unnest(['CPA', 'Revshare Ongoing PL']), 0.0::DOUBLE FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events)"""

ORACLE["vendor_breakdown"] = f"""
WITH {VENDOR}
SELECT operator, brand, currency,
       CASE WHEN operator = 'Openbet' AND brand = 'Brand R' THEN lower(s_name) ELSE lower(operator) END AS ref_key,
       CAST(sum(rs) AS DOUBLE) AS rs_amount, CAST(sum(cpa) AS DOUBLE) AS cpa_amount, count(*) AS n_rows
FROM vendor GROUP BY ALL"""

ORACLE["operator_override"] = f"""
WITH {WIDE}
SELECT operator, brand, username, month,
       CASE WHEN operator = '1-URGENT' THEN 0 ELSE CAST(price AS DOUBLE) END AS rs_amount,
       CASE WHEN operator = '1-URGENT' THEN -CAST(price AS DOUBLE) ELSE CAST(o_orderkey AS DOUBLE) END AS cpa_amount
FROM wide"""

ORACLE["union_reports"] = f"""
WITH {WIDE}, {VENDOR}, {COMMISSION}, {CONDITIONAL}, u AS (
  SELECT 'Wide' AS platform, 'EUR' AS currency, brand, username, price::DECIMAL(38,2) AS rs, o_orderkey::DECIMAL(38,2) AS cpa FROM wide
  UNION ALL SELECT 'Vendors', currency, brand, username, rs, cpa FROM vendor
  UNION ALL SELECT 'Long', 'EUR', 'b', {txt('user_id')}, rs, cpa FROM sums
  UNION ALL SELECT 'Lingual', '', '', c_name, {cents('c_acctbal')}, c_nationkey FROM customer)
SELECT platform, currency, brand, count(*) AS n_rows, CAST(sum(rs) AS DOUBLE) AS rs_amount,
       CAST(sum(cpa) AS DOUBLE) AS cpa_amount, max(username) AS last_username FROM u GROUP BY ALL"""

ORACLE["earliest_quote"] = f"""
WITH t AS (
  SELECT strftime(ts, '%d') AS month, event_type AS currency,
         CASE WHEN event_type = 'error' AND value > 20 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS quoted,
         CASE WHEN event_type = 'view' AND value > 60 THEN 'n/a' ELSE {cents_text('value')} END AS rate FROM events),
first AS (SELECT month, currency, rate FROM t
          QUALIFY row_number() OVER (PARTITION BY month, currency ORDER BY quoted NULLS LAST, rate) = 1)
SELECT month, currency, CAST(CAST(rate AS DECIMAL(18,8)) AS DOUBLE) AS rate FROM first WHERE rate <> 'n/a'"""

ORACLE["fx_convert"] = f"""
WITH {DAY_RATES}, {ORDER_AMOUNTS}
SELECT o_orderkey, {money('r.cents')} AS rate, {money(half_up('100 * a.cents', 'r.cents'))} AS rs_eur,
       -{money(half_up('100 * a.cents', 'r.cents'))} AS cpa_eur
FROM amounts a LEFT JOIN rates r USING (month, currency)"""

ORACLE["fx_rebase"] = f"""
WITH {DAY_RATES}, {ORDER_AMOUNTS}, t AS (
  SELECT o_orderkey, a.currency, r.cents AS rate, a.cents AS rs, 2500 AS cpa,
         {half_up('100 * a.cents', 'r.cents')} AS rs_eur, {half_up('250000', 'r.cents')} AS cpa_eur, l.cents AS local,
         o_orderstatus = 'F' AND a.currency = 'signup' AND coalesce(l.cents, 0) <> 0 AS hit
  FROM amounts a LEFT JOIN rates r USING (month, currency)
  LEFT JOIN rates l ON l.month = a.month AND l.currency = 'purchase')
SELECT o_orderkey, CASE WHEN hit THEN 'purchase' ELSE currency END AS currency,
       {money('CASE WHEN hit THEN local ELSE rate END')} AS rate,
       {money(f"CASE WHEN hit THEN {half_up('rs_eur * local', '100')} ELSE rs END")} AS rs_amount,
       {money(f"CASE WHEN hit THEN {half_up('cpa_eur * local', '100')} ELSE cpa END")} AS cpa_amount,
       {money('rs_eur')} AS rs_eur, {money('cpa_eur')} AS cpa_eur FROM t"""

ORACLE["missing_rates"] = f"""
WITH {DAY_RATES}, {ORDER_AMOUNTS}
SELECT DISTINCT month, currency FROM amounts
WHERE (month, currency) NOT IN (SELECT (month, currency) FROM rates WHERE currency <> 'click')"""

ORACLE["rate_feed_explode"] = f"""
WITH f AS (
  SELECT CASE WHEN event_type = 'error' THEN '' ELSE {month("date_trunc('month', ts) - INTERVAL 1 DAY")} END AS month,
         CASE WHEN event_type = 'error' THEN strftime(ts, '%d/%m/%Y %H:%M') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS quote_ts,
         event_type AS base_code, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, value AS v FROM events),
flat AS (SELECT month, quote_ts, base_code, 'k' AS currency, k AS rate FROM f WHERE k IS NOT NULL
         UNION ALL SELECT month, quote_ts, base_code, 'v', v FROM f)
SELECT month, quote_ts, base_code, currency, rate FROM flat WHERE NOT (currency = 'v' AND quote_ts IN (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') FROM events WHERE event_type = 'view'))
QUALIFY row_number() OVER (PARTITION BY quote_ts, currency ORDER BY month, base_code, rate) = 1"""

ORACLE["unknown_currencies"] = """
SELECT currency FROM (VALUES ('view'), ('click'), ('ZZZ')) w(currency)
WHERE currency NOT IN (SELECT event_type FROM events)"""

ORACLE["ref_enrich"] = f"""
WITH {ACCOUNTS}, {REFERENCE}, {UNION_ROWS}
SELECT o_orderkey, ref, netting FROM union_rows
JOIN refs ON lower(operator) = k AND lower(username) = u AND lower(brand) = b WHERE ref IS NOT NULL"""

ORACLE["divergences"] = f"""
WITH {ACCOUNTS}, {UNION_ROWS}
SELECT platform, operator, username, brand FROM union_rows WHERE platform = 'FURNITURE'"""

ORACLE["preferred_reference"] = f"WITH {SHEET}, {PREFERRED} SELECT * FROM preferred"

ORACLE["netting_update"] = f"""
WITH {SHEET}, {PREFERRED}, ref AS (
  SELECT 'op' AS operator, {txt('c_custkey')} AS username, 'B ' AS brand,
         CASE WHEN c_nationkey < 12 THEN 'o' ELSE 'F' END AS ref, CASE WHEN c_acctbal > 0 THEN 'None' ELSE 'Old' END AS netting
  FROM customer)
SELECT r.operator, r.username, r.brand, r.ref,
       CASE WHEN p.username IS NOT NULL THEN CASE WHEN p.netting = '' THEN 'No' ELSE p.netting END
            WHEN r.netting = 'None' THEN 'No' ELSE r.netting END AS netting
FROM ref r LEFT JOIN preferred p ON p.username = r.username AND lower(p.ref) = lower(r.ref)"""

ORACLE["missing_accounts"] = f"""
WITH s AS (SELECT c_custkey, c_nationkey, c_name, {SHEET_LOGIN} AS username FROM customer)
SELECT c_custkey, username FROM s
WHERE NOT EXISTS (SELECT 1 FROM customer l WHERE l.c_nationkey = s.c_nationkey AND l.c_acctbal < 6000
  AND contains('_' || lower(s.username) || '_', '_' || lower(l.c_name) || '_'))"""

ORACLE["id_filter"] = f"""
WITH {ACCOUNTS}, {UNION_ROWS}
SELECT o_orderkey, operator, username FROM union_rows WHERE platform = 'BUILDING'"""

ORACLE["upsert_replace"] = f"""
WITH {STORED}
SELECT o_custkey, month, o_orderkey, o_orderstatus, CAST(amount AS DOUBLE) AS amount FROM stored
WHERE (o_custkey, coalesce(month, '')) NOT IN (SELECT (o_custkey, coalesce(month, '')) FROM stored WHERE o_orderstatus = 'F')
UNION ALL SELECT o_custkey, month, o_orderkey, NULL, CAST(amount + 10 AS DOUBLE) FROM stored WHERE o_orderstatus = 'F'"""

ORACLE["upsert_purge"] = f"""
WITH {STORED}
SELECT o_custkey, month, o_orderkey, o_orderstatus, CAST(amount AS DOUBLE) AS amount FROM stored
WHERE (o_custkey, coalesce(month, '')) NOT IN (SELECT (o_custkey, coalesce(month, '')) FROM stored WHERE o_orderstatus <> 'P')
UNION ALL SELECT o_custkey, month, o_orderkey, o_orderstatus, CAST(amount + 10 AS DOUBLE) FROM stored WHERE o_orderstatus = 'F'"""


def billing(netting: str, cpa: str, rs: str) -> str:
    """Billing total over whole cents."""
    return (f"CASE WHEN {cpa} IS NULL OR {rs} IS NULL THEN 0 "
            f"WHEN {netting} = 'No' THEN {cpa} + greatest({rs}, 0) "
            f"WHEN {netting} = 'Sí' THEN greatest({cpa} + {rs}, 0) ELSE {cpa} + {rs} END")


ORACLE["billing_total"] = f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'No' WHEN 'R' THEN 'Sí' ELSE 'other' END AS netting,
         CASE WHEN l_discount > 0.02 THEN {whole('l_extendedprice')} ELSE 0 END AS cpa,
         CASE WHEN l_linestatus = 'F' THEN -2 * {whole('l_extendedprice')} WHEN l_tax > 0.01 THEN {whole('l_quantity')} END AS rs
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, {money(billing('netting', 'cpa', 'rs'))} AS total FROM t"""

ORACLE["currency_default"] = f"""
WITH {ACCOUNTS}, t AS (
  SELECT account_id, operator, username, platform <> 'FURNITURE' AS was_blank,
         CASE WHEN platform = 'FURNITURE' THEN 'USD' WHEN brand = 'ASIA' THEN 'BRL' ELSE 'EUR' END AS currency FROM accounts)
SELECT account_id, currency, CASE WHEN operator = 'NATION_8' AND currency = 'USD' THEN 'moved' ELSE username END AS username,
       was_blank FROM t"""

ORACLE["pending_fx"] = f"""
WITH t AS (SELECT {txt('o_orderkey')} AS row_key, {whole('o_totalprice')} AS c, o_orderstatus = 'P' AS pending,
                  o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' AS done FROM orders)
SELECT row_key, pending AND NOT done AS pending_fx, CAST(CASE WHEN done THEN 5.25 WHEN NOT pending THEN 1 END AS DOUBLE) AS rate,
       CASE WHEN done THEN CAST(c * 525 AS DOUBLE) / 10000 WHEN NOT pending THEN {money('c')} END AS rs_amount,
       CAST(CASE WHEN done THEN 10.5 WHEN NOT pending THEN 5 END AS DOUBLE) AS cpa_amount,
       CASE WHEN done THEN CAST((c + 200) * 525 AS DOUBLE) / 10000 WHEN NOT pending THEN {money('c + 500')} END AS total_amount
FROM t"""

ORACLE["rule_table"] = f"""
WITH r AS (SELECT CASE WHEN s_suppkey % 3 > 0 THEN {txt('s_nationkey')} END AS nation, CASE WHEN s_suppkey % 4 > 0 THEN ['F', 'O', 'P'][s_nationkey % 3 + 1] END AS status,
                  printf('%06d', s_suppkey) AS rule FROM supplier),
b AS (SELECT nation, status, min(rule) AS rule, CASE WHEN nation IS NOT NULL AND status IS NOT NULL THEN 0 WHEN nation IS NOT NULL THEN 1 WHEN status IS NOT NULL THEN 2 ELSE 3 END AS rank FROM r GROUP BY ALL),
o AS (SELECT o_orderkey, {txt('c_nationkey')} AS nation_key, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, nation_key, o_orderstatus, min_by(rule, rank) AS rule
FROM o LEFT JOIN b ON coalesce(nation = nation_key, true) AND coalesce(status = o_orderstatus, true) GROUP BY ALL"""

ORACLE["late_rate_merge"] = f"""
WITH t AS (SELECT {txt('o_orderkey')} AS row_key, strftime(o_orderdate, '%d') AS month, {whole('o_totalprice')} AS c, o_orderstatus = 'P' AS pending,
                  o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' AS done FROM orders)
SELECT row_key, month, pending AND NOT done AS pending_fx, CAST(CASE WHEN done THEN 5.25 WHEN NOT pending THEN 1 END AS DOUBLE) AS rate,
       CASE WHEN done THEN CAST((c * 525 + 50) // 100 AS DOUBLE) / 100 WHEN NOT pending THEN {money('c')} END AS rs_amount,
       CAST(CASE WHEN done THEN 10.5 WHEN NOT pending THEN 5 END AS DOUBLE) AS cpa_amount,
       CAST(CASE WHEN done THEN 15.75 WHEN NOT pending THEN 7 END AS DOUBLE) AS total_amount
FROM t"""

ORACLE["publish_ledger"] = f"""
WITH new AS (SELECT {txt('o_custkey')} AS "Index", strftime(o_orderdate, '%Y-%m') AS "AnoMes", {cents_text('o_totalprice')} AS price, o_orderstatus AS status, o_custkey, o_orderpriority FROM orders),
stored AS (SELECT "Index", "AnoMes", price, CASE WHEN o_orderpriority = '1-URGENT' THEN 'old' ELSE status END AS status FROM new WHERE o_custkey % 3 <> 0),
a AS (SELECT "Index", "AnoMes", count(*) AS n, list_sort(list(price || '/' || status)) AS said FROM new GROUP BY ALL),
b AS (SELECT "Index", "AnoMes", count(*) AS n, list_sort(list(price || '/' || status)) AS said FROM stored GROUP BY ALL)
SELECT "Index", "AnoMes", price, status, CAST(NULL AS BIGINT) AS n_before, CAST(NULL AS BIGINT) AS n_rows FROM new WHERE o_custkey % 3 = 0
UNION ALL SELECT "Index", "AnoMes", NULL, 'changed', b.n, a.n FROM a JOIN b USING ("Index", "AnoMes") WHERE a.said <> b.said"""

ORACLE["row_keys"] = f"""
WITH {ACCOUNTS}, {UNION_ROWS}
SELECT o_orderkey, '2024-01' || account_id || platform || username AS row_key,
       operator || '_' || username || 'x' AS origin FROM union_rows"""

ORACLE["publish_text"] = f"""
SELECT {txt('o_orderkey')} AS o_orderkey, replace({cents_text('o_totalprice')}, '.', ',') AS price,
       o_orderpriority AS priority,
       CASE WHEN o_orderstatus = 'F' THEN '-' || replace({cents_text('o_totalprice')}, '.', ',') ELSE '' END AS note,
       'v1.2' AS label FROM orders"""

ORACLE["replaced_text"] = f"""
SELECT {txt('o_orderkey')} AS o_orderkey, {cents_text('o_totalprice')} AS price,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS priority, CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS even
FROM orders"""

ORACLE["load_counters"] = f"""
WITH {ACCOUNTS}, {REFERENCE}, {UNION_ROWS}, {DAY_RATES}, {ORDER_AMOUNTS}
SELECT platform, count(*) AS n_rows, count(*) FILTER (ref IS NULL) AS n_without_ref,
       count(*) FILTER (cents IS NULL) AS n_without_rate, count(*) FILTER (ref IS NOT NULL) AS n_kept
FROM union_rows JOIN (SELECT o_orderkey, month, currency FROM amounts) USING (o_orderkey)
JOIN refs ON lower(operator) = k AND lower(username) = u AND lower(brand) = b
LEFT JOIN (SELECT * FROM rates WHERE currency <> 'click') USING (month, currency) GROUP BY platform"""

ORACLE["outcomes"] = f"""
WITH n AS (SELECT o_custkey, count(*) AS n_rows FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT {txt('c_custkey')} AS account_id, coalesce(n_rows, 0) AS n_rows,
       CASE WHEN n_rows > 0 THEN 'data' WHEN c_acctbal > 1000 AND c_nationkey > 4 THEN 'no data' ELSE 'error' END AS outcome
FROM customer LEFT JOIN n ON c_custkey = o_custkey"""

ORACLE["run_log"] = f"""
WITH {STEPS}
SELECT '2024-01-01T00:00:00' AS run_at, month, {txt('o_orderkey')} AS step, CAST(rc AS INTEGER) AS returncode,
       CASE rc WHEN 0 THEN 'OK' WHEN -1 THEN 'TIMEOUT' ELSE 'ERRO' END AS status, {hms(STEP_SECONDS)} AS duration FROM steps"""

ORACLE["run_totals"] = f"""
WITH {STEPS}, s AS (SELECT month, count(*) FILTER (rc = 0) AS n_ok, count(*) FILTER (rc <> 0) AS n_failed,
                           CAST(sum({STEP_SECONDS_UP}) AS BIGINT) AS secs FROM steps GROUP BY month)
SELECT month, n_ok, n_failed, {hms('secs')} AS duration FROM s"""

ORACLE["offset_header_scan"] = f"""
SELECT c_mktsegment AS tab, CAST(c_custkey + 10 AS INTEGER) AS row_no,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_name END AS name,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name ELSE {txt('c_nationkey')} END AS nation, '' AS gone
FROM customer WHERE c_acctbal > 0"""

ORACLE["reference_tabs"] = f"""
SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'Brand M' ELSE 'Brand B' END AS brand, '' AS platform, c_name AS username,
       {cents_text('c_acctbal')} AS ref, CASE WHEN c_acctbal > 0 THEN 'RS' ELSE 'CPA' END AS commission, {txt('c_nationkey')} AS netting,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 0 ELSE 1 END AS tab_no, CAST(c_custkey + 9 AS INTEGER) AS row_no
FROM customer WHERE c_mktsegment IN ('MACHINERY', 'BUILDING')"""

ORACLE["ragged_rows"] = """
WITH d AS (SELECT doc_id, [string_split(x, ' ') for x in string_split(text, chr(10))] AS rows FROM documents),
w AS (SELECT doc_id, rows, list_max([len(r) for r in rows]) AS width FROM d),
e AS (SELECT doc_id, width, unnest(rows) AS cells, unnest(range(len(rows))) AS row_no FROM w)
SELECT doc_id, CAST(row_no AS INTEGER) AS row_no, CAST(width AS INTEGER) AS width,
       array_to_string(cells, '|') || repeat('|', CAST(width - len(cells) AS BIGINT)) AS cells FROM e"""

ORACLE["html_rows"] = r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages),
e AS (SELECT page_id, unnest(range(len(items))) AS row_no, unnest(items) AS item FROM l)
SELECT page_id, CAST(row_no AS INTEGER) AS row_no, replace(trim(regexp_replace(item, '<[^>]*>', '', 'g')), '&amp;', '&') AS text
FROM e"""

ORACLE["unified_billing"] = f"""
WITH {DAY_RATES}, {COMMISSION}, {CONDITIONAL},
vendor AS (
  SELECT s_name, l_linestatus, l_returnflag, strftime(l_shipdate, '%d') AS month,
         sum({whole('l_extendedprice')}) AS rs, sum({whole('l_quantity')}) AS cpa
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
u AS (
  SELECT 'Wide' AS platform, CASE WHEN o_orderpriority = '2-HIGH' THEN 'High Operator' ELSE o_orderpriority END AS operator,
         o_orderstatus AS brand, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'moved' ELSE {txt('o_custkey')} END AS username,
         strftime(o_orderdate, '%d') AS month,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'view' WHEN o_orderstatus = 'O' THEN 'purchase' ELSE 'signup' END AS currency,
         '' AS vendor_name, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE -{whole('o_totalprice')} END AS rs,
         CASE WHEN o_orderpriority = '1-URGENT' THEN {whole('o_totalprice')} ELSE 100 * o_orderkey END AS cpa
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'Vendors', CASE WHEN l_linestatus = 'O' THEN 'Openbet' ELSE 'Closedbet' END,
         CASE WHEN l_returnflag = 'R' THEN 'Brand R' ELSE 'Brand X' END, s_name, month,
         CASE WHEN l_returnflag = 'A' THEN 'click' ELSE 'none' END, s_name, rs, cpa FROM vendor
  UNION ALL
  SELECT 'Long', 'op', 'b', {txt('user_id')}, month, 'view', '', CAST(rs * 100 AS HUGEINT), CAST(cpa * 100 AS HUGEINT) FROM sums
  UNION ALL
  SELECT DISTINCT 'Lingual', c_mktsegment, 'O', c_name, '07', 'purchase', '', {whole('c_acctbal')}, 100 * c_nationkey FROM customer),
converted AS (
  SELECT u.* EXCLUDE (currency), u.currency AS reported, r.cents AS own, l.cents AS local,
         {half_up('100 * rs', 'r.cents')} AS rs_eur, {half_up('100 * cpa', 'r.cents')} AS cpa_eur,
         brand = 'F' AND u.currency = 'signup' AND coalesce(l.cents, 0) <> 0 AS hit
  FROM u LEFT JOIN rates r USING (month, currency)
  LEFT JOIN rates l ON l.month = u.month AND l.currency = 'purchase'),
based AS (
  SELECT platform, operator, brand, username, month, vendor_name, rs_eur, cpa_eur,
         CASE WHEN hit THEN 'purchase' ELSE reported END AS currency, CASE WHEN hit THEN local ELSE own END AS rate,
         CASE WHEN hit THEN {half_up('rs_eur * local', '100')} ELSE rs END AS rs,
         CASE WHEN hit THEN {half_up('cpa_eur * local', '100')} ELSE cpa END AS cpa FROM converted),
acct AS (SELECT *, CASE WHEN c_acctbal < 1000 THEN 'No' WHEN c_acctbal < 5000 THEN 'Sí' ELSE 'No' END AS netting FROM customer),
refs AS (
  SELECT operator AS k, {txt('c_custkey')} AS un, b, c_custkey AS id, netting
  FROM acct, (VALUES ('1-urgent'), ('high operator'), ('4-not specified'), ('5-low')) p(operator), (VALUES ('o'), ('f')) s(b)
  WHERE c_nationkey <> 7
  UNION ALL SELECT '3-medium', 'moved', 'o', -1, 'No' UNION ALL SELECT '3-medium', 'moved', 'f', -2, 'Sí'
  UNION ALL SELECT 'closedbet', lower(s_name), 'brand r', s_suppkey, 'Sí' FROM supplier
  UNION ALL SELECT 'openbet', lower(s_name), 'brand x', s_suppkey, 'Sí' FROM supplier
  UNION ALL SELECT lower(s_name), lower(s_name), 'brand r', s_suppkey, 'Sí' FROM supplier
  UNION ALL SELECT DISTINCT 'op', {txt('user_id')}, 'b', user_id, 'other' FROM events
  UNION ALL SELECT lower(c_mktsegment), lower(c_name), 'o', c_custkey, netting FROM acct),
joined AS (
  SELECT based.*, 'R' || id AS ref, netting,
         platform = 'Vendors' AND username = 'Supplier#000000001' AS pending
  FROM based JOIN refs ON un = lower(username) AND b = lower(brand)
    AND k = CASE WHEN operator = 'Openbet' AND brand = 'Brand R' THEN lower(vendor_name) ELSE lower(operator) END),
billed AS (SELECT *, {billing('netting', 'cpa', 'rs')} AS total, {billing('netting', 'cpa_eur', 'rs_eur')} AS total_eur FROM joined)
SELECT month || ref || platform || username AS "Index", month AS "AnoMes", brand AS "Marca", platform AS "Plataforma",
       'Sí' AS "Automatizado", ref AS "ReferenciaFacturacion", operator || '_' || username AS "Origen", operator AS "Operador",
       username AS "Login", netting AS "Resta", currency AS "Moneda_Operador",
       CASE WHEN pending OR rate IS NULL THEN '' ELSE {money_text('rate')} || '000000' END AS "ValorMoneda_XE",
       CASE WHEN pending THEN 'Esperar cambio' ELSE {money_text('rs')} END AS "RS_Operador", {money_text('rs_eur')} AS "RS_EUR",
       CASE WHEN pending THEN 'Esperar cambio' ELSE {money_text('cpa')} END AS "CPA_Operador", {money_text('cpa_eur')} AS "CPA_EUR",
       CASE WHEN pending THEN 'Esperar cambio' ELSE {money_text('total')} END AS "TotalFacturacion_Operador",
       {money_text('total_eur')} AS "TotalFacturacion_EUR"
FROM billed"""
