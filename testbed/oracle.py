"""DuckDB SQL for every checked query.

Named table expressions mirror ``testbed/bank.py``; the statements say the expected
result in another way than the Spark plans where there is another way to say it.
"""

from __future__ import annotations

import re

KEY = "k-test"
RUN = "TIMESTAMP '2024-04-01 06:30:00'"
START = "TIMESTAMP '2024-01-01'"

COLUMNS = (
    "transaction_id, sender_iban, beneficiary_iban, amount, currency, payment_channel, "
    "status, blocked_reason, executed_at"
)


def pad(value: str, width: int) -> str:
    return f"lpad(CAST({value} AS VARCHAR), {width}, '0')"


def iban(number: str) -> str:
    return f"'FR' || {pad(f'{number} % 97', 2)} || {pad(number, 23)}"


def text_of(cents: str) -> str:
    whole = f"replace(format('{{:,}}', {cents} // 100), ',', '.')"
    return f"{whole} || ',' || {pad(f'{cents} % 100', 2)}"


def hashed(column: str) -> str:
    return f"sha256('{KEY}' || {column})"


def masked(column: str) -> str:
    return f"left({column}, 4) || '****' || right({column}, 4)"


def parsed(text: str, cast: str = "CAST") -> str:
    return f"{cast}(replace(replace({text}, '.', ''), ',', '.') AS DECIMAL(18,2))"


def payment(at: str) -> str:
    return f"""
    SELECT event_id,
           'T' || {pad('event_id', 10)} AS transaction_id,
           {iban('user_id')} AS sender_iban,
           (CASE WHEN event_id % 10 >= 3 THEN 'FR'
                 ELSE ['DE', 'ES', 'IT'][event_id % 3 + 1] END)
             || {pad('event_id % 89', 2)} || {pad('event_id', 18)} AS beneficiary_iban,
           CAST(round(value * 4000) AS BIGINT) AS cents,
           CASE event_type WHEN 'purchase' THEN 'INSTANT_SEPA' WHEN 'click' THEN 'CARD'
                           WHEN 'view' THEN 'CARD' ELSE 'SEPA' END AS payment_channel,
           {at} AS executed_at
    FROM events"""


def live(source: str, cents: str = "cents") -> str:
    return f"""
    SELECT event_id, transaction_id, sender_iban, beneficiary_iban,
           {text_of(cents)} AS amount, 'EUR' AS currency, payment_channel,
           CASE WHEN event_id % 47 = 0 THEN 'BLOCKED' ELSE 'PENDING' END AS status,
           CASE WHEN event_id % 47 = 0 THEN 'MANUAL' END AS blocked_reason, executed_at
    FROM {source}"""


def staged(source: str, ingested: str) -> str:
    return f"""
    SELECT transaction_id,
           {hashed('sender_iban')} AS sender_iban_hmac,
           {masked('sender_iban')} AS sender_iban_truncated,
           {hashed('beneficiary_iban')} AS beneficiary_iban_hmac,
           {masked('beneficiary_iban')} AS beneficiary_iban_truncated,
           {parsed('amount')} AS amount_eur, currency, payment_channel, status, blocked_reason,
           executed_at, left(beneficiary_iban, 2) <> 'FR' AS is_cross_border, {ingested} AS ingested_at
    FROM {source}"""


def merged(settlements: str, transactions: str = "stg_transactions") -> str:
    """Full outer join of the staged sides, as two halves."""
    shared = (
        "sender_iban_hmac, sender_iban_truncated, beneficiary_iban_hmac, "
        "beneficiary_iban_truncated"
    )
    return f"""
    SELECT a.transaction_id, {', '.join('a.' + c for c in shared.split(', '))},
           ifnull(b.amount_eur, a.amount_eur) AS amount_eur, a.currency, a.payment_channel,
           CASE WHEN a.status <> 'BLOCKED' AND b.transaction_id IS NOT NULL THEN 'SETTLED'
                ELSE a.status END AS final_status,
           a.blocked_reason, a.executed_at, a.is_cross_border,
           TRUE AS seen_in_stream, b.transaction_id IS NOT NULL AS seen_in_settlement
    FROM {transactions} a LEFT JOIN {settlements} b USING (transaction_id)
    UNION ALL
    SELECT transaction_id, {shared}, amount_eur, currency, payment_channel, 'SETTLED',
           NULL, executed_at, is_cross_border, FALSE, TRUE
    FROM {settlements} WHERE transaction_id NOT IN (SELECT transaction_id FROM {transactions})"""


OPEN_CANDIDATES = "is_cross_border AND final_status <> 'BLOCKED'"

TABLES = {
    "raw_customers": f"""
    SELECT c_custkey AS n, 'C' || {pad('c_custkey', 9)} AS customer_id, c_name AS first_name,
           'L' || c_custkey AS last_name, 'c' || c_custkey || '@example.com' AS email,
           '+33' || {pad('c_custkey', 9)} AS phone_number, {iban('c_custkey')} AS iban,
           c_custkey || ' rue ' || c_mktsegment AS address, n_name AS city, 'FR' AS country,
           CASE WHEN c_custkey * 37 % 100 < 70 THEN 'LOW' WHEN c_custkey * 37 % 100 < 90 THEN 'MEDIUM'
                WHEN c_custkey * 37 % 100 < 97 THEN 'HIGH' ELSE 'PEP' END AS risk_tier,
           TIMESTAMP '2022-01-01' + to_hours(CAST(c_custkey AS INTEGER)) AS created_at
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 13 <> 5""",
    "ev": payment(f"{START} + (ts - {START}) * 3"),
    "raw_transactions": live("ev") + " WHERE event_id % 101 <> 0",
    "raw_settlements": f"""
    SELECT * REPLACE ('SETTLED' AS status, CAST(NULL AS VARCHAR) AS blocked_reason) FROM (
    {live('ev', '(CASE WHEN event_id % 20 = 1 THEN cents + 50 + event_id % 451 ELSE cents END)')}
    WHERE event_id % 4 <> 0)""",
    "stg_transactions": staged("raw_transactions", RUN),
    "stg_settlements": staged("raw_settlements", RUN),
    "stg_customers": f"""
    SELECT customer_id, first_name, last_name, email, phone_number, {hashed('iban')} AS iban_hmac,
           {masked('iban')} AS iban_truncated, address, city, country, risk_tier, created_at,
           {RUN} AS ingested_at FROM raw_customers""",
    "reconciled": merged("stg_settlements"),
    "facts": """
    SELECT r.*, customer_id, risk_tier
    FROM reconciled r LEFT JOIN stg_customers ON iban_hmac = sender_iban_hmac""",
    "rolling": f"""
    SELECT sender_iban_hmac, sender_iban_truncated, transaction_id, amount_eur, executed_at,
           CAST(sum(amount_eur) OVER (PARTITION BY sender_iban_hmac ORDER BY executed_at
             RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(28,2))
             AS rolling_30d_cross_border_eur
    FROM reconciled WHERE {OPEN_CANDIDATES}""",
    "alerts": f"""
    SELECT transaction_id, sender_iban_hmac, sender_iban_truncated, customer_id, risk_tier,
           amount_eur, executed_at, rolling_30d_cross_border_eur,
           'CUMULATIVE_CROSS_BORDER_10K' AS rule_code, {RUN} AS detected_at
    FROM rolling LEFT JOIN stg_customers ON iban_hmac = sender_iban_hmac
    WHERE rolling_30d_cross_border_eur > 10000""",
    "settled_twice": """
    SELECT * FROM stg_settlements UNION ALL
    SELECT * FROM stg_settlements WHERE CAST(substr(transaction_id, 2) AS BIGINT) % 15 = 1""",
    "reconciled_twice": merged("settled_twice"),
    "feed": live(f"({payment(f'make_timestamp(epoch_us({START}) + (epoch_us(ts) - epoch_us({START})) // 240)')})"),
    "candidates": """
    SELECT transaction_id, f.sender_iban, executed_at, event_id, risk_tier
    FROM feed f JOIN raw_customers ON iban = f.sender_iban
    WHERE payment_channel = 'INSTANT_SEPA' AND risk_tier IN ('HIGH', 'PEP')""",
    "blocks": """
    SELECT a.transaction_id, count(*) AS event_count,
           'VELOCITY_RULE: ' || count(*) || ' INSTANT_SEPA in 60 min | risk_tier=' || any_value(a.risk_tier)
             AS blocked_reason
    FROM candidates a JOIN candidates b
      ON b.sender_iban = a.sender_iban AND b.executed_at > a.executed_at - INTERVAL 60 MINUTES
     AND (b.executed_at, b.event_id) <= (a.executed_at, a.event_id)
    GROUP BY a.transaction_id HAVING count(*) >= 5""",
    "crowded": f"""
    SELECT * REPLACE (CASE WHEN sender_iban = (SELECT sender_iban FROM candidates GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
                           THEN {START} ELSE executed_at END AS executed_at) FROM candidates""",
    "crowded_open": f"""
    SELECT * REPLACE (CASE WHEN sender_iban_hmac = (SELECT sender_iban_hmac FROM reconciled WHERE {OPEN_CANDIDATES}
                                                    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
                           THEN {START} ELSE executed_at END AS executed_at) FROM reconciled WHERE {OPEN_CANDIDATES}""",
    # Arrival of a fifth of the payments up to 40 minutes late, in six slices.
    "arrivals": f"""
    SELECT *, since * 1000000 + event_id % 1000000 AS arrival, least(since // 2200000000, 5) AS slice
    FROM (SELECT *, epoch_us(executed_at) - epoch_us({START})
            + CASE WHEN event_id % 5 = 0 THEN event_id * 7919 % 40 ELSE 0 END * 60000000 AS since FROM feed)""",
    # Behind the newest watched payment of earlier slices by ten minutes, in whole milliseconds.
    "watermarks": """
    SELECT s.slice, max(epoch_us(executed_at)) // 1000 * 1000 - 600000000 AS mark
    FROM (SELECT DISTINCT slice FROM arrivals) s JOIN arrivals a ON a.slice < s.slice
    WHERE payment_channel = 'INSTANT_SEPA' GROUP BY s.slice""",
    "watched": """
    SELECT a.transaction_id, a.sender_iban, a.slice, a.arrival, epoch_us(executed_at) AS at, risk_tier,
           coalesce(epoch_us(executed_at) <= mark, FALSE) AS late
    FROM arrivals a JOIN raw_customers ON iban = a.sender_iban LEFT JOIN watermarks w ON w.slice = a.slice
    WHERE payment_channel = 'INSTANT_SEPA' AND risk_tier IN ('HIGH', 'PEP')""",
    # An arrival counts until a later one is an hour newer, also for those dated before that one.
    "counted_exact": """
    SELECT k.transaction_id, any_value(k.risk_tier) AS risk_tier, any_value(k.slice) AS slice, count(*) AS event_count
    FROM watched k JOIN watched i ON i.sender_iban = k.sender_iban AND i.arrival <= k.arrival
    WHERE i.at > (SELECT max(m.at) FROM watched m WHERE m.sender_iban = k.sender_iban
                  AND m.arrival BETWEEN i.arrival AND k.arrival) - 3600000000
    GROUP BY k.transaction_id""",
    "in_time": "SELECT * FROM watched WHERE NOT late",
    "counted_in_time": """
    SELECT k.transaction_id, any_value(k.slice) AS slice, count(*) AS event_count
    FROM in_time k JOIN in_time i ON i.sender_iban = k.sender_iban AND i.arrival <= k.arrival
    WHERE i.at > (SELECT max(m.at) FROM in_time m WHERE m.sender_iban = k.sender_iban
                  AND m.arrival BETWEEN i.arrival AND k.arrival) - 3600000000
    GROUP BY k.transaction_id""",
    "decided": f"""
    SELECT {COLUMNS.replace('transaction_id', 'f.transaction_id')
            .replace('status, blocked_reason', '''CASE WHEN event_count > 0 THEN 'BLOCKED' ELSE status END AS status,
           coalesce(k.blocked_reason, f.blocked_reason) AS blocked_reason''')}
    FROM feed f LEFT JOIN blocks k ON k.transaction_id = f.transaction_id""",
    "stg_decided": staged("decided", RUN),
    "reconciled_decided": merged("stg_settlements", "stg_decided"),
    "settlement_files": f"""
    SELECT * REPLACE ('SETTLED' AS status), CAST(executed_at AS DATE) + k AS file_date FROM (
    SELECT p.*, k FROM (SELECT unnest([1, 2, 3]) AS k) days, LATERAL (
    {live('ev', '(CASE WHEN event_id % 20 = 1 THEN cents + k ELSE cents END)')}
    WHERE event_id % 47 <> 0 AND (event_id + k) % 4 <> 0) p)""",
    "customer_batches": """
    SELECT TIMESTAMP '2024-01-05' + to_days(14 * run) AS run_ts, run, customer_id, address,
           CASE WHEN (n * 7 + run) % 11 <> 0 THEN city END AS city,
           CASE WHEN (n + run) % 4 = 0 THEN 'BE' ELSE country END AS country,
           CASE WHEN (n + run) % 5 = 0 THEN 'HIGH' ELSE risk_tier END AS risk_tier, created_at
    FROM raw_customers, (SELECT CAST(unnest(range(6)) AS INTEGER) AS run) runs
    WHERE (n + run * 3) % 9 <> 0""",
    "versions": """
    SELECT * EXCLUDE (is_new), lead(run_ts) OVER (PARTITION BY customer_id ORDER BY run_ts) AS valid_to
    FROM (SELECT b.*, NOT EXISTS (
            SELECT 1 FROM customer_batches o WHERE o.customer_id = b.customer_id AND o.run < b.run
            AND o.run = (SELECT max(run) FROM customer_batches m
                         WHERE m.customer_id = b.customer_id AND m.run < b.run)
            AND o.risk_tier IS NOT DISTINCT FROM b.risk_tier
            AND o.address IS NOT DISTINCT FROM b.address
            AND o.city IS NOT DISTINCT FROM b.city) AS is_new FROM customer_batches b)
    WHERE is_new""",
    "dirty_payments": f"""
    SELECT event_id,
           CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 37 = 1
                THEN 'T' || {pad('(event_id - 1)', 10)} ELSE transaction_id END AS transaction_id,
           CASE WHEN event_id % 43 = 0 THEN left({hashed('sender_iban')}, 60)
                WHEN event_id % 53 <> 0 THEN {hashed('sender_iban')} END AS sender_iban_hmac,
           CAST(CASE WHEN event_id % 59 = 0 THEN -{parsed('amount')} - 1
                WHEN event_id % 61 <> 0 THEN {parsed('amount')} END AS DECIMAL(18,2)) AS amount_eur,
           CASE WHEN event_id % 67 = 0 THEN 'LOST' WHEN event_id % 71 <> 0 THEN status END AS status
    FROM ({live('ev')})""",
    "dirty_customers": f"""
    SELECT CASE WHEN n % 17 = 3 THEN 'C' || {pad('(n - 3)', 9)} ELSE customer_id END AS customer_id,
           CASE WHEN n % 19 <> 0 THEN first_name END AS first_name,
           CASE WHEN n % 23 = 0 THEN repeat(last_name, 30) ELSE last_name END AS last_name,
           email, phone_number, CASE WHEN n % 29 = 0 THEN 'FR00' ELSE iban END AS iban, address, city,
           CASE WHEN n % 31 = 0 THEN 'FRANCE' ELSE country END AS country,
           CASE WHEN n % 37 <> 0 THEN risk_tier END AS risk_tier,
           CASE WHEN n % 41 <> 0 THEN created_at END AS created_at
    FROM raw_customers""",
}


def sql(statement: str) -> str:
    """Prefix a statement with the table expressions it uses, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in TABLES.items():
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(statement)
    if not needed:
        return statement
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name]})" for name in needed) + "\n" + statement


def report(source: str, checks: dict[str, str]) -> str:
    lines = [
        f"SELECT '{name}' AS check_name, CAST({failures} AS BIGINT) AS failures FROM {source}"
        for name, failures in checks.items()
    ]
    return "\nUNION ALL ".join(lines)


def nulls(column: str) -> str:
    return f"count(*) - count({column})"


def repeats(source: str, column: str) -> str:
    counted = f"SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return f"max((SELECT count(*) FROM ({counted})))"


LENGTHS = {
    "customer_id": 36, "first_name": 100, "last_name": 100, "email": 255, "phone_number": 30,
    "iban": 34, "address": 500, "city": 100, "country": 5, "risk_tier": 10,
}
CUSTOMER_CHECKS = {
    **{f"unique({c})": repeats("dirty_customers", c) for c in ("customer_id", "iban")},
    **{
        f"not_null({c})": nulls(c)
        for c in ("customer_id", "first_name", "last_name", "iban", "risk_tier", "created_at")
    },
    **{f"max_length({c})": f"count(*) FILTER (length({c}) > {n})" for c, n in LENGTHS.items()},
}
PAYMENT_CHECKS = {
    "unique(transaction_id)": repeats("dirty_payments", "transaction_id"),
    "not_null(transaction_id)": nulls("transaction_id"),
    "not_null(sender_iban_hmac)": nulls("sender_iban_hmac"),
    "length(sender_iban_hmac)": "count(*) FILTER (length(sender_iban_hmac) <> 64)",
    "not_null(amount_eur)": nulls("amount_eur"),
    "between(amount_eur)": "count(*) FILTER (amount_eur < 0)",
    "accepted(status)": "count(*) FILTER (status = 'LOST')",
}
VERSIONS = """
SELECT customer_id, address, city, country, risk_tier, created_at,
       md5(customer_id || '|' || CAST(run_ts AS VARCHAR)) AS version_id,
       run_ts AS updated_at, run_ts AS valid_from, valid_to FROM versions"""
GAPPY = "CASE WHEN event_id % 13 <> 0 THEN sender_iban END"
SHORT = "left(beneficiary_iban, 3)"
ROLLING = "SELECT * FROM rolling"
BLOCKS = "SELECT transaction_id, event_count, blocked_reason FROM blocks"
BLOCKS_BY_ARRIVAL = """
SELECT transaction_id, event_count,
       'VELOCITY_RULE: ' || event_count || ' INSTANT_SEPA in 60 min | risk_tier=' || risk_tier AS blocked_reason
FROM counted_exact WHERE event_count >= 5"""
BROKEN = "event_id % 97 = 5"


def unless_broken(expression: str) -> str:
    return f"CASE WHEN NOT ({BROKEN}) THEN {expression} END"


STATEMENTS = {
    "src_bronze_extract": f"SELECT {COLUMNS} FROM raw_transactions",
    "src_settlements_latest_file": f"""
    SELECT {COLUMNS}, {RUN} AS loaded_at FROM settlement_files
    WHERE file_date = (SELECT max(file_date) FROM settlement_files)""",
    "src_settlement_file": f"""
    SELECT {COLUMNS}, {RUN} AS loaded_at FROM settlement_files WHERE file_date = DATE '2024-01-20'""",
    "src_settlements_merge_latest": f"""
    SELECT {COLUMNS}, {RUN} AS loaded_at FROM settlement_files
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY file_date DESC) = 1""",
    "src_settlements_incremental": f"""
    SELECT {COLUMNS}, {RUN} + to_hours(CAST(day(file_date) * 2 % 3 AS INTEGER)) AS loaded_at, file_date FROM settlement_files
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY file_date DESC) = 1""",
    "risk_lookup": "SELECT iban, risk_tier FROM raw_customers",
    "block_overlay": """
    SELECT transaction_id, sender_iban, beneficiary_iban, amount, currency, payment_channel,
           CASE WHEN event_id % 31 = 0 THEN 'BLOCKED' ELSE status END AS status,
           CASE WHEN event_id % 62 = 0 THEN 'SECOND' WHEN event_id % 31 = 0 THEN 'FIRST'
                ELSE blocked_reason END AS blocked_reason, executed_at
    FROM raw_transactions""",
    "insert_absent_txns": """
    SELECT transaction_id, sender_iban, beneficiary_iban, amount, currency, payment_channel,
           CASE WHEN event_id % 3 <> 0 AND event_id % 5 = 0 THEN 'SETTLED' ELSE status END AS status,
           blocked_reason, executed_at
    FROM raw_transactions""",
    "insert_absent_customers": f"""
    SELECT * EXCLUDE (n) FROM raw_customers
    UNION ALL
    SELECT * EXCLUDE (n) REPLACE ('N' || {pad('n', 9)} AS customer_id, 'ZZ' || {pad('n', 9)} AS iban)
    FROM raw_customers WHERE n % 6 = 0""",
    "publish_json": """
    SELECT sender_iban AS key,
           '{"transaction_id":"' || transaction_id || '","sender_iban":"' || sender_iban
           || '","beneficiary_iban":"' || beneficiary_iban || '","amount":"' || amount
           || '","currency":"EUR","payment_channel":"' || payment_channel || '","status":"' || status
           || '","blocked_reason":' || CASE WHEN status = 'BLOCKED' THEN '"MANUAL"' ELSE 'null' END
           || ',"executed_at":"' || strftime(executed_at, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS value
    FROM raw_transactions""",
    "validate_records": f"""
    SELECT {unless_broken('transaction_id')} AS transaction_id,
           {unless_broken("CASE WHEN event_id % 19 <> 0 THEN sender_iban END")} AS sender_iban,
           {unless_broken('beneficiary_iban')} AS beneficiary_iban,
           {unless_broken('amount')} AS amount, {unless_broken('currency')} AS currency,
           {unless_broken("CASE WHEN event_id % 17 = 0 THEN 'CHEQUE' ELSE payment_channel END")}
             AS payment_channel,
           CASE WHEN {BROKEN} THEN 'PENDING' WHEN event_id % 29 = 0 THEN 'LOST'
                WHEN event_id % 3 <> 0 THEN status ELSE 'PENDING' END AS status,
           CAST(NULL AS VARCHAR) AS blocked_reason,
           {unless_broken('CASE WHEN event_id % 23 <> 0 THEN executed_at END')} AS executed_at,
           CASE WHEN {BROKEN} THEN 'missing transaction_id; missing sender_iban; missing beneficiary_iban; '
             || 'missing amount; missing currency; missing payment_channel; missing executed_at'
           ELSE concat_ws('; ',
             CASE WHEN event_id % 19 = 0 THEN 'missing sender_iban' END,
             CASE WHEN event_id % 17 = 0 THEN 'unknown payment_channel' END,
             CASE WHEN event_id % 29 = 0 THEN 'unknown status' END,
             CASE WHEN event_id % 23 = 0 THEN 'bad executed_at' END) END AS reason,
           CASE WHEN {BROKEN} THEN '{{oops' ELSE '{{' || concat_ws(',',
             '"transaction_id":"' || transaction_id || '"',
             CASE WHEN event_id % 19 <> 0 THEN '"sender_iban":"' || sender_iban || '"' END,
             '"beneficiary_iban":"' || beneficiary_iban || '"', '"amount":"' || amount || '"',
             '"currency":"' || currency || '"',
             '"payment_channel":"' || CASE WHEN event_id % 17 = 0 THEN 'CHEQUE' ELSE payment_channel END || '"',
             CASE WHEN event_id % 29 = 0 THEN '"status":"LOST"' WHEN event_id % 3 <> 0 THEN '"status":"' || status || '"' END,
             '"executed_at":"' || CASE WHEN event_id % 23 = 0 THEN 'not-a-time' ELSE CAST(executed_at AS VARCHAR) END || '"'
           ) || '}}' END AS payload
    FROM ({live('ev')})""",
    "csv_export": "SELECT * EXCLUDE (n) FROM raw_customers",
    "settlement_export": f"""
    SELECT {COLUMNS.replace('amount', "CASE WHEN file_date = DATE '2024-01-20' THEN '0,00' ELSE amount END AS amount")},
           file_date FROM settlement_files""",
    "pseudonymize_iban": f"""
    SELECT transaction_id, {hashed(GAPPY)} AS sender_hash, {hashed(SHORT)} AS short_hash FROM ev""",
    "truncate_iban": f"""
    SELECT transaction_id, {masked(GAPPY)} AS sender_masked, {masked(SHORT)} AS short_masked FROM ev""",
    "parse_eu_amount": f"""
    SELECT transaction_id, CAST(cents / 100 AS DECIMAL(18,2)) AS amount_strict,
           {parsed('odd', 'TRY_CAST')} AS amount_lenient
    FROM (SELECT transaction_id, cents, CASE event_id % 7
            WHEN 0 THEN (cents // 100) || '.' || {pad('cents % 100', 2)}
            WHEN 1 THEN {text_of('cents')} || '5' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
            ELSE {text_of('cents')} END AS odd FROM ev)""",
    "format_eu_amount": f"""
    SELECT transaction_id, (cents // 100) || ',' || {pad('cents % 100', 2)} AS amount_text FROM ev""",
    "cross_border_flag": """
    SELECT transaction_id, CASE event_id % 11 WHEN 0 THEN TRUE WHEN 1 THEN NULL
                           ELSE event_id % 10 < 3 END AS is_cross_border FROM ev""",
    "date_exprs": """
    SELECT transaction_id, executed_at - INTERVAL 720 HOURS AS alert_window_start,
           executed_at - INTERVAL 1 HOUR AS velocity_cutoff, CAST(executed_at AS DATE) AS executed_on,
           strftime(executed_at, '%Y-%m-%dT%H:%M:%S.%f') AS executed_iso, executed_at AS parsed_back,
           epoch_us(executed_at) AS epoch_micros, executed_at AS from_epoch_micros FROM ev""",
    "stg_transactions": "SELECT * FROM stg_transactions",
    "stg_settlements": "SELECT * FROM stg_settlements",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_customers_without_pii": """
    SELECT customer_id, iban_hmac, iban_truncated, city, country, risk_tier, created_at, ingested_at
    FROM stg_customers""",
    "settlement_eligible": f"""
    SELECT {COLUMNS} FROM raw_transactions WHERE status = 'PENDING'
    AND datediff('day', CAST(executed_at AS DATE), DATE '2024-02-10') IN (1, 2, 3)""",
    "reconcile": "SELECT * FROM reconciled",
    "reconcile_from_bronze": "SELECT * FROM reconciled",
    "fct_transactions": "SELECT * FROM facts",
    "rolling_30d": ROLLING,
    "rolling_30d_sliced": ROLLING,
    "aml_alerts": "SELECT * FROM alerts",
    "alerts_selfjoin": f"""
    SELECT g.* EXCLUDE (total), CAST(total AS DECIMAL(28,2)) AS rolling_30d_cross_border_eur,
           customer_id, risk_tier, 'CUMULATIVE_CROSS_BORDER_10K' AS rule_code, {RUN} AS detected_at
    FROM (SELECT x.sender_iban_hmac, x.sender_iban_truncated, x.transaction_id, x.amount_eur,
                 x.executed_at, sum(y.amount_eur) AS total
          FROM (SELECT * FROM reconciled_twice WHERE {OPEN_CANDIDATES}) x
          JOIN (SELECT * FROM reconciled_twice WHERE {OPEN_CANDIDATES}) y
            ON y.sender_iban_hmac = x.sender_iban_hmac AND y.executed_at <= x.executed_at
           AND y.executed_at >= x.executed_at - INTERVAL 30 DAYS
          GROUP BY ALL) g
    LEFT JOIN stg_customers ON iban_hmac = sender_iban_hmac WHERE total > 10000""",
    "velocity_batch": BLOCKS,
    "velocity_batch_sliced": BLOCKS,
    "velocity_stream": BLOCKS,
    "velocity_one_second": """
    SELECT a.transaction_id, count(*) AS event_count,
           'VELOCITY_RULE: ' || count(*) || ' INSTANT_SEPA in 60 min | risk_tier=' || any_value(a.risk_tier) AS blocked_reason
    FROM crowded a JOIN crowded b
      ON b.sender_iban = a.sender_iban AND b.executed_at > a.executed_at - INTERVAL 60 MINUTES
     AND (b.executed_at, b.event_id) <= (a.executed_at, a.event_id)
    GROUP BY a.transaction_id HAVING count(*) >= 5""",
    "rolling_30d_one_second": """
    SELECT sender_iban_hmac, sender_iban_truncated, transaction_id, amount_eur, executed_at,
           CAST(sum(amount_eur) OVER (PARTITION BY sender_iban_hmac ORDER BY executed_at
             RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS rolling_30d_cross_border_eur
    FROM crowded_open""",
    "decisions_compacted": BLOCKS,
    "velocity_keyed": BLOCKS_BY_ARRIVAL,
    "velocity_recovered": BLOCKS_BY_ARRIVAL,
    "velocity_late_events": """
    SELECT transaction_id, event_count, FALSE AS late FROM counted_in_time
    UNION ALL SELECT transaction_id, NULL, TRUE FROM watched WHERE late""",
    "replays_dropped": "SELECT transaction_id, executed_at, 1::BIGINT AS n_rows FROM feed",
    "run_counters": """
    SELECT run, counter, CAST(sum(n) AS BIGINT) AS total FROM (
      SELECT 1 + slice // 3 AS run, 'events' AS counter, 1 AS n FROM arrivals
      UNION ALL SELECT 1 + slice // 3, 'late', CAST(late AS INTEGER) FROM watched
      UNION ALL SELECT 1 + slice // 3, 'blocked', CAST(event_count >= 5 AS INTEGER) FROM counted_in_time)
    GROUP BY ALL""",
    "scd2_history": VERSIONS,
    "scd2_incremental": VERSIONS,
    "as_of_lookup": """
    SELECT transaction_id, f.customer_id, executed_at, v.risk_tier AS asof_risk_tier,
           v.city AS asof_city, v.run_ts AS asof_valid_from
    FROM facts f LEFT JOIN versions v ON v.customer_id = f.customer_id AND v.run_ts <= executed_at
     AND executed_at < coalesce(v.valid_to, TIMESTAMP '9999-01-01')""",
    "dq_unique": """
    SELECT transaction_id, count(*) AS n_rows FROM dirty_payments
    GROUP BY 1 HAVING count(transaction_id) > 1""",
    "dq_not_null": "SELECT * FROM dirty_payments WHERE transaction_id IS NULL",
    "dq_accepted": "SELECT * FROM dirty_payments WHERE status NOT IN ('PENDING', 'SETTLED', 'BLOCKED')",
    "dq_length": "SELECT * FROM dirty_payments WHERE length(sender_iban_hmac) <> 64",
    "dq_between": "SELECT * FROM dirty_payments WHERE NOT amount_eur BETWEEN 0 AND 9000",
    "dq_row_count": "SELECT count(*) AS n_rows FROM dirty_payments HAVING count(*) > 10",
    "dq_constraints": report("dirty_customers", CUSTOMER_CHECKS),
    "dq_gate": report("dirty_payments", PAYMENT_CHECKS),
    "dq_quarantine": """
    SELECT * FROM (SELECT event_id, concat_ws('; ',
      CASE WHEN transaction_id IS NULL THEN 'not_null(transaction_id)' END,
      CASE WHEN sender_iban_hmac IS NULL THEN 'not_null(sender_iban_hmac)' END,
      CASE WHEN length(sender_iban_hmac) <> 64 THEN 'length(sender_iban_hmac)' END,
      CASE WHEN amount_eur IS NULL THEN 'not_null(amount_eur)' END,
      CASE WHEN amount_eur < 0 THEN 'between(amount_eur)' END,
      CASE WHEN status = 'LOST' THEN 'accepted(status)' END) AS reason FROM dirty_payments)
    WHERE reason <> ''""",
    "dq_at_load": """
    SELECT event_id, transaction_id, CASE WHEN reason = '' AND row_number() OVER (PARTITION BY transaction_id, reason = '' ORDER BY event_id) > 1
      THEN 'unique(transaction_id)' ELSE reason END AS reason
    FROM (SELECT event_id, transaction_id, concat_ws('; ',
      CASE WHEN transaction_id IS NULL THEN 'not_null(transaction_id)' END,
      CASE WHEN sender_iban_hmac IS NULL THEN 'not_null(sender_iban_hmac)' END,
      CASE WHEN length(sender_iban_hmac) <> 64 THEN 'length(sender_iban_hmac)' END,
      CASE WHEN amount_eur IS NULL THEN 'not_null(amount_eur)' END,
      CASE WHEN amount_eur < 0 THEN 'between(amount_eur)' END,
      CASE WHEN status = 'LOST' THEN 'accepted(status)' END) AS reason FROM dirty_payments)""",
    "kpi_totals": """
    SELECT count(*) AS total_transactions, count(*) FILTER (final_status = 'BLOCKED') AS flagged_transactions,
           count(*) FILTER (final_status = 'BLOCKED') / count(*) AS fraud_rate FROM facts""",
    "kpi_tiers": "SELECT risk_tier, count(*) AS customers FROM stg_customers GROUP BY 1",
    "kpi_reconciliation": """
    SELECT final_status, count(*) AS transactions, count(*) / (SELECT count(*) FROM facts) AS share
    FROM facts GROUP BY 1""",
    "kpi_fraud_breakdown": """
    SELECT breakdown, risk_tier, payment_channel, count(*) AS transactions, sum(bad)::BIGINT AS blocked,
           sum(bad)::BIGINT / count(*) AS fraud_rate
    FROM (
      SELECT 'risk_tier' AS breakdown, risk_tier, NULL AS payment_channel,
             CAST(final_status = 'BLOCKED' AS INTEGER) AS bad FROM facts
      UNION ALL SELECT 'payment_channel', NULL, payment_channel, CAST(final_status = 'BLOCKED' AS INTEGER)
      FROM facts
      UNION ALL SELECT 'risk_tier+payment_channel', risk_tier, payment_channel,
                       CAST(final_status = 'BLOCKED' AS INTEGER) FROM facts)
    GROUP BY 1, 2, 3""",
    "alert_listing": """
    SELECT rule_code, transaction_id, sender_iban_truncated, customer_id, risk_tier,
           rolling_30d_cross_border_eur FROM alerts""",
    "live_feed": "SELECT * FROM decided ORDER BY executed_at DESC, transaction_id DESC LIMIT 50",
    "live_blocked_count": "SELECT count(*) AS blocked_transactions FROM decided WHERE status = 'BLOCKED'",
    "live_velocity_alerts": """
    SELECT transaction_id, sender_iban, executed_at, blocked_reason FROM decided
    WHERE blocked_reason LIKE 'VELOCITY_RULE%'""",
    "batch_facts_after_stream": """
    SELECT r.*, customer_id, risk_tier
    FROM reconciled_decided r LEFT JOIN stg_customers ON iban_hmac = sender_iban_hmac""",
    "batch_alerts_after_stream": f"""
    SELECT a.*, customer_id, risk_tier, 'CUMULATIVE_CROSS_BORDER_10K' AS rule_code, {RUN} AS detected_at
    FROM (SELECT sender_iban_hmac, sender_iban_truncated, transaction_id, amount_eur, executed_at,
                 CAST(sum(amount_eur) OVER (PARTITION BY sender_iban_hmac ORDER BY executed_at
                   RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(28,2)) AS rolling_30d_cross_border_eur
          FROM reconciled_decided WHERE {OPEN_CANDIDATES}) a
    LEFT JOIN stg_customers ON iban_hmac = sender_iban_hmac WHERE rolling_30d_cross_border_eur > 10000""",
    "batch_run": """
    SELECT 'fct_transactions' AS table_name, count(*) AS n_rows,
           CAST(sum(amount_eur) AS DECIMAL(38,2)) AS total FROM facts
    UNION ALL SELECT 'fct_daily_aml_alerts', count(*), CAST(sum(rolling_30d_cross_border_eur) AS DECIMAL(38,2))
    FROM alerts
    UNION ALL SELECT 'snap_customers', count(*), NULL FROM raw_customers""",
}

STATEMENTS["incremental_facts"] = STATEMENTS["batch_facts_after_stream"]
STATEMENTS["incremental_alerts"] = f"SELECT * EXCLUDE (detected_at) FROM ({STATEMENTS['batch_alerts_after_stream']}) every_alert"

ORACLES = {name: sql(statement) for name, statement in STATEMENTS.items()}
