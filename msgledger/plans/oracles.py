"""The registered queries as ANSI SQL over the given tables.

Where a query reads derived text, the SQL reads the source columns the text was made from,
so that it does not share the query's patterns.
"""
from __future__ import annotations

from msgledger.plans.views import ACCOUNT, LEDGER, NOTICE, TEXT


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_NOTICES = f"notices AS (SELECT {_select(NOTICE)} FROM {_ORDERS})"
_TEXTS = f"texts AS (SELECT *, {TEXT} AS text FROM notices)"
_ACCOUNTS = f"accounts AS (SELECT {_select(ACCOUNT)} FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_LEDGER = f"ledger AS (SELECT {_select(LEDGER)} FROM orders)"
_RUNS = """runs AS (SELECT cast(cast(ts AS date) AS varchar) AS run_id,
    count(*) FILTER (event_type <> 'error') AS success, count(*) FILTER (event_type = 'error') AS failed
  FROM events GROUP BY 1)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def _interval(source: str, s: str, n: str, keys: str) -> str:
    """Exact binomial bounds by bisection on the summed tail, as CTE ``ci``.

    ``source`` has ``keys`` (unique), ``s`` and ``n``. The lower bound makes P(X >= s) = 0.025,
    the upper one P(X <= s) = 0.025.
    """
    def tail(first: str, last: str, p: str) -> str:
        term = (f"exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln({p}) + (n - k) * ln(1 - {p}))")
        return f"list_sum(list_transform(range({first}, {last} + 1), lambda k: {term}))"

    mid_l, mid_u = "((ll + lh) / 2)", "((ul + uh) / 2)"
    return f"""steps AS (
    SELECT {keys}, cast({s} AS bigint) AS s, cast({n} AS bigint) AS n, 0 AS i,
      0.0::double AS ll, 1.0::double AS lh, 0.0::double AS ul, 1.0::double AS uh
    FROM {source}
    UNION ALL
    SELECT {keys}, s, n, i + 1,
      CASE WHEN {tail('s', 'n', mid_l)} < 0.025 THEN {mid_l} ELSE ll END,
      CASE WHEN {tail('s', 'n', mid_l)} < 0.025 THEN lh ELSE {mid_l} END,
      CASE WHEN {tail('0', 's', mid_u)} > 0.025 THEN {mid_u} ELSE ul END,
      CASE WHEN {tail('0', 's', mid_u)} > 0.025 THEN uh ELSE {mid_u} END
    FROM steps WHERE i < 40
  ), ci AS (
    SELECT {keys}, s, n, CASE WHEN s = 0 THEN 0.0 ELSE (ll + lh) / 2 END AS pmin,
      CASE WHEN s = n THEN 1.0 ELSE (ul + uh) / 2 END AS pmax
    FROM steps WHERE i = 40
  )"""


_WORDS = [f"(sum(('0x' || substr(h, {1 + 16 * i}, 16))::ubigint) % 18446744073709551616)::varchar" for i in range(4)]


def _fingerprint(table: str, columns: list[str]) -> str:
    cells = []
    for c in sorted(columns):
        cell = f"coalesce(trim(cast({c} AS varchar), chr(32) || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)), '')"
        cells.append(f"'{len(c)}:{c}' || length({cell})::varchar || ':' || {cell}")
    row = " || ".join(cells)
    return (
        f"SELECT count(*) AS n_rows, sha256('{','.join(sorted(columns))}:' || count(*)::varchar || ':' || {' || chr(58) || '.join(_WORDS)}) AS fingerprint "
        f"FROM (SELECT sha256({row}) AS h FROM {table})"
    )


_MAILBOX = """mailbox AS (SELECT message_id, ord, priority, 'alerts@' || lower(segment) || '.example' AS sender,
    'Transaction ' || status AS subject, day AS sent_date FROM notices)"""
_WANTED = "priority = '1-URGENT' AND sender IN ('alerts@building.example', 'alerts@automobile.example') AND sent_date >= DATE '1997-01-01'"

# First account, in list order, whose number ends with a value.
_ENDINGS = """endings AS (SELECT ending, arg_min(internal_entity, position) AS e, arg_min(institution, position) AS i FROM (
    SELECT right(internal_account_number, cast(k AS bigint)) AS ending, position, internal_entity, institution
    FROM accounts, unnest(range(1, 11)) AS u(k)) GROUP BY ending)"""
_SUFFIXES = """suffixes AS (SELECT right(internal_account_number, 4) AS suffix, arg_max(internal_account_number, position) AS a,
    arg_max(internal_entity, position) AS e, arg_max(institution, position) AS i FROM accounts GROUP BY 1)"""

# What each kind of generated answer comes to.
_PARSED = f"""kinds AS (SELECT *, ord % 8 AS k, CASE ord % 8 WHEN 1 THEN last4 WHEN 2 THEN cast(custkey AS varchar) ELSE account END AS number
    FROM notices), parsed AS (SELECT message_id, ord,
    CASE WHEN k IN (0, 1, 2, 7) THEN 'json' WHEN ord % 16 = 6 THEN 'failed' ELSE 'regex' END AS parse_path,
    CASE WHEN k IN (0, 1, 2, 7, 4) THEN day WHEN k = 6 AND ord % 16 <> 6 THEN day END AS d,
    CASE WHEN k IN (0, 1, 2, 7) THEN number WHEN k IN (3, 4, 5) THEN last4 END AS internal_account_number,
    CASE WHEN k IN (0, 1, 2, 7) THEN endings.e END AS internal_entity,
    CASE WHEN k IN (0, 1, 2, 7) THEN endings.i END AS institution,
    CASE WHEN k = 0 THEN 'at ' || entity WHEN k IN (1, 2, 7) THEN 'Shop 7' WHEN k = 3 THEN 'Statement ready'
         WHEN k = 4 THEN entity WHEN k = 5 THEN entity || ' Ltd' WHEN ord % 16 <> 6 THEN 'Shop ' || entity END AS external_entity,
    CASE WHEN k = 3 OR ord % 16 = 6 THEN NULL ELSE amount END AS amount,
    CASE WHEN k IN (0, 1, 2, 7) THEN CASE WHEN ord % 16 < 8 THEN balance END
         WHEN k = 3 OR ord % 16 = 6 THEN NULL ELSE balance END AS available_balance,
    CASE WHEN k IN (0, 1, 2, 7, 4) THEN 'ZAR' WHEN k = 5 THEN 'USD' WHEN k = 6 AND ord % 16 <> 6 THEN '€' END AS currency,
    CASE WHEN k IN (0, 1, 2, 7) THEN 'card purchase at ' || entity END AS description,
    CASE WHEN k IN (0, 1, 2, 7) THEN 'card' END AS transaction_type,
    CASE WHEN k IN (0, 1, 2, 7) THEN 'alerts@' || lower(kinds.institution) || '.example' END AS source_email
  FROM kinds LEFT JOIN endings ON number = endings.ending)"""

_GAPPY = f"""gappy AS (SELECT *, CASE WHEN ord % 5 <> 0 THEN 'ZAR' END AS currency,
    CASE WHEN ord % 7 = 0 THEN '' ELSE 'card' END AS description FROM ledger)"""
_FLAGS = """flags AS (SELECT run_id, message_id, 'a@b.example' AS sender, '' AS subject,
    'missing: ' || array_to_string(list_filter([CASE WHEN currency IS NULL THEN 'currency' END,
      CASE WHEN description = '' THEN 'description' END,
      CASE WHEN available_balance IS NULL THEN 'available_balance' END], lambda x: x IS NOT NULL), ', ') AS reason
  FROM gappy WHERE currency IS NULL OR description = '' OR available_balance IS NULL)"""

_RUNNING = """running AS (SELECT *, sum(amount) OVER w AS s FROM ledger
    WINDOW w AS (PARTITION BY internal_account_number ORDER BY date, ord ROWS UNBOUNDED PRECEDING))"""


def _fill(backward: str) -> str:
    return _with(_LEDGER, _RUNNING, f"""based AS (SELECT *,
        last_value(available_balance - s IGNORE NULLS) OVER (PARTITION BY internal_account_number ORDER BY date, ord
          ROWS UNBOUNDED PRECEDING) AS back,
        first_value(available_balance - s IGNORE NULLS) OVER (PARTITION BY internal_account_number ORDER BY date, ord
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead,
        first_value(CASE WHEN available_balance IS NOT NULL THEN amount END IGNORE NULLS) OVER (
          PARTITION BY internal_account_number ORDER BY date, ord
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead_amount
      FROM running)""") + f"""SELECT message_id, internal_account_number,
        cast(coalesce(available_balance, back + s, {backward}) AS double) AS available_balance FROM based"""


_SIDES = """sides AS (SELECT message_id, ord, amount, CASE WHEN amount < 0 THEN 0 ELSE 1 END AS side,
    CASE WHEN ord % 11 = 0 THEN 'not a date' ELSE cast(date AS varchar) END AS d FROM ledger)"""

_MATCHES = """matches AS (SELECT r AS run, message_id,
    NOT (r > 1 AND (ord * r) % 211 = 0) AS struct_match,
    NOT (r > 1 AND ((ord * r) % 211 = 0 OR (ord * r) % 97 = 0)) AS id_match, 100 + r * 3 AS latency_ms
  FROM ledger, unnest(range(1, 6)) AS u(r))"""
_RATES = """rates AS (SELECT run, count(*) AS n, count(*) FILTER (struct_match) AS struct_ok, count(*) FILTER (id_match) AS id_ok,
    max(latency_ms) AS latency_ms FROM matches GROUP BY run)"""

_HTML = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'),
    '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[a-zA-Z/!?](?:[^>=]|=\\s*(?:"[^"]*"|''[^'']*'')?)*>', ' ', 'g')"""


def _entities(sql: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        sql = f"replace({sql}, '{name}', '{char}')"
    return sql


_DAILY_ORDERS = "daily AS (SELECT date, count(*) AS tx_count FROM ledger GROUP BY date)"
_TRAILING = """scored AS (SELECT date, tx_count,
    avg(tx_count) OVER w AS m, stddev_pop(tx_count) OVER w AS sd FROM daily
    WINDOW w AS (ORDER BY date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))"""

_LEDGER_RUN = """good AS (SELECT * FROM parsed WHERE parse_path <> 'failed'),
  firsts AS (SELECT internal_account_number, min(ord) AS bucket_ord FROM good GROUP BY 1)"""

# The body each MIME shape of the derived mail holds.
_BODY = """CASE ord % 6 WHEN 0 THEN regexp_replace(text, '\\s+', ' ', 'g') || ' Terms & more €'
    WHEN 3 THEN 'snippet ' || ord
    WHEN 5 THEN regexp_replace(text, '\\s+', ' ', 'g') || ' end'
    ELSE regexp_replace(text, '\\s+', ' ', 'g') END"""

ORACLES: dict[str, str] = {
    # --- sources
    "message_filter_limit": _with(_NOTICES, _MAILBOX) + f"""
        SELECT message_id, ord, sender, subject, cast(sent_date AS varchar) AS sent_date FROM mailbox
        WHERE {_WANTED} ORDER BY ord LIMIT 500""",
    "message_scan": _with(_NOTICES, _TEXTS) + f"""SELECT message_id, ord,
        CASE WHEN ord % 3 < 2 THEN ord || '@bank.example' ELSE message_id END AS canonical_id,
        'Bank <alerts@' || lower(institution) || '.example>' AS sender, 'transaction ' || status AS subject,
        cast(CASE WHEN ord % 2 = 0 THEN day + 1 ELSE day END AS varchar) AS sent_date, 'INBOX|' || priority AS labels,
        {_BODY} AS body FROM texts""",
    "message_filter": _with(_NOTICES, _MAILBOX) + f"SELECT sender, subject, count(*) AS n FROM mailbox WHERE {_WANTED} GROUP BY 1, 2",
    "sender_allowlist": """SELECT doc_id, source FROM documents WHERE source IN (
        SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY source HAVING count(*) % 2 = 1)""",
    "account_scan": _with(_ACCOUNTS) + """SELECT internal_account_number, internal_account_number AS digits,
        right(internal_account_number, 4) AS last4, owner_type FROM accounts""",
    "master_state": """SELECT count(*) AS known_ids, max(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END) AS max_id,
        cast(cast(max(o_orderdate) AS date) AS varchar) AS last_date FROM orders""",
    "high_water_mark": """SELECT 'latest' AS kind, strftime(max(ts) - INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS since FROM events
        UNION ALL SELECT 'wide overlap', strftime(max(ts) - INTERVAL 36 HOURS, '%Y-%m-%d %H:%M:%S.%f') FROM events""",
    "attachment_inventory": """SELECT 'm' || o_orderkey AS message_id, 'inv_' || o_orderkey || '.PDF' AS filename,
        'att' || o_orderkey AS attachment_id FROM orders WHERE o_orderkey % 6 IN (1, 3)""",
    "attachment_inventory_top": """SELECT 'm' || o_orderkey AS message_id, 'inv_' || o_orderkey || '.PDF' AS filename,
        'att' || o_orderkey AS attachment_id FROM orders WHERE o_orderkey % 6 = 1""",
    "attachment_layout": """SELECT CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Personal' ELSE 'Company' END AS bucket,
        strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, count(*) AS files,
        sum(length('inv_' || o_orderkey || '.PDF'))::bigint AS bytes
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 6 IN (1, 3) GROUP BY 1, 2, 3""",
    # --- message text
    "header_map": f"""SELECT 'm' || o_orderkey AS id, 'Bank <alerts@' || lower(n_name) || '.example>' AS sender,
        'transaction ' || o_orderstatus AS subject, 4 AS names FROM {_ORDERS}""",
    "canonical_id": f"""SELECT 'm' || o_orderkey AS id,
        CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey || '@bank.example' ELSE 'm' || o_orderkey END AS canonical_id FROM {_ORDERS}""",
    "sent_date": f"""SELECT 'm' || o_orderkey AS id, cast(cast(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY
        ELSE o_orderdate END AS date) AS varchar) AS sent_date FROM {_ORDERS}""",
    "mime_body": _with(_NOTICES, _TEXTS) + f"""SELECT message_id AS id,
        CASE WHEN ord % 6 = 0 THEN 'text/html' WHEN ord % 6 <> 3 THEN 'text/plain' END AS kind, {_BODY} AS body FROM texts""",
    "html_text": f"SELECT page_id, trim(regexp_replace({_entities(_entities(_HTML))}, '\\s+', ' ', 'g')) AS text FROM pages",
    "collapse_space": "SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents",
    "attach_text": _with(_NOTICES, _TEXTS) + """SELECT message_id, text || CASE
        WHEN status = 'F' AND ord % 2 = 0 THEN chr(10) || chr(10) || priority || chr(10) || chr(10) || 'page ' || ord
        WHEN status = 'F' THEN chr(10) || chr(10) || priority
        WHEN status = 'O' AND ord % 2 = 0 THEN chr(10) || chr(10) || 'page ' || ord ELSE '' END AS body FROM texts""",
    "prompt_build": _with(_NOTICES, _TEXTS, """numbered AS (SELECT s_suppkey AS k, s_name, lpad(s_suppkey::varchar, 10, '0') AS n FROM supplier),
      lines AS (SELECT min(k) AS at_, max_by('- ' || s_name || ' (' || n || ') (last4=' || right(n, 4) || ')', k) AS line
        FROM numbered GROUP BY right(n, 4)),
      listed AS (SELECT string_agg(line, chr(10) ORDER BY at_) AS block FROM lines)""") + """SELECT message_id,
        length(prompt)::bigint AS chars, sha256(prompt) AS prompt_sha256 FROM (SELECT message_id, 'Your internal accounts:' || chr(10) || block || chr(10) || chr(10)
        || 'Answer with one JSON object that fits this schema, and nothing else.' || chr(10) || '<JSON_SCHEMA>' || chr(10)
        || 'date: date, internal_account_number: str, internal_entity: str, institution: str, external_entity: str (optional), '
        || 'amount: number, available_balance: number (optional), currency: str, description: str, transaction_type: str, '
        || 'source_email: str, message_id: str, run_id: str' || chr(10) || '</JSON_SCHEMA>' || chr(10) || chr(10)
        || 'From: ' || institution || chr(10) || 'Subject: ' || left('Transaction for ' || repeat(entity, 8), 120)
        || chr(10) || chr(10) || 'Body:' || chr(10) || '\"\"\"' || text || '\"\"\"' || chr(10) || chr(10) || 'JSON:' || chr(10) AS prompt
        FROM texts, listed)""",
    # --- extraction
    "extract_label": _with(_NOTICES) + """SELECT message_id, CASE ord % 4 WHEN 0 THEN entity WHEN 1 THEN entity || ' Ltd'
        WHEN 2 THEN 'Shop ' || entity END AS external_entity FROM notices""",
    "extract_date": _with(_NOTICES) + "SELECT message_id, CASE WHEN ord % 4 IN (0, 2) THEN cast(day AS varchar) END AS date FROM notices",
    "extract_amount": _with(_NOTICES) + """SELECT message_id, CASE WHEN ord % 4 < 3 THEN cast(amount AS double) END AS amount,
        CASE ord % 4 WHEN 0 THEN 'ZAR' WHEN 1 THEN 'USD' WHEN 2 THEN '€' END AS currency FROM notices""",
    "extract_last4": _with(_NOTICES) + "SELECT message_id, CASE WHEN ord % 4 <> 2 THEN last4 END AS last4 FROM notices",
    "extract_balance": _with(_NOTICES) + """SELECT message_id, CASE WHEN ord % 4 < 3 THEN cast(balance AS double) END AS balance,
        CASE WHEN ord % 4 = 0 THEN 'ZAR' END AS currency FROM notices""",
    "extract_balance_simple": _with(_NOTICES) + """SELECT message_id,
        CASE WHEN ord % 4 = 0 THEN cast(balance AS double) END AS balance FROM notices""",
    "extract_counterparty": _with(_NOTICES) + """SELECT message_id, CASE ord % 4 WHEN 0 THEN 'Payment notice'
        WHEN 1 THEN 'Merchant ' || entity WHEN 2 THEN 'Bank X' ELSE 'Statement ready' END AS line FROM notices""",
    "extract_all": """WITH found AS (SELECT doc_id, regexp_extract_all(text,
          '(?i)(?:payee|recipient|merchant|vendor|Payment made to|Paid to|“Beneficiary”|“Payment received by”)\\s*:\\s*(.+)', 1) AS labels,
          list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]'), lambda l: trim(l, chr(32) || chr(9) || chr(160))),
            lambda l: l <> '' AND NOT regexp_matches(l, '\\b\\d{4}-\\d{2}-\\d{2}\\b') AND regexp_extract(l, $amt$, 0) = '') AS lines,
          regexp_extract(text, '\\b(\\d{4}-\\d{2}-\\d{2})\\b', 1) AS d, regexp_extract(text, $amt$, 0) AS a FROM documents)
        SELECT doc_id, CASE WHEN len(labels) > 0 THEN trim(labels[-1]) ELSE left(lines[1], 50) END AS external_entity,
          try_cast(replace(regexp_replace(a, '[^0-9.,]', '', 'g'), ',', '') AS double) AS amount,
          cast(try_cast(nullif(d, '') AS date) AS varchar) AS date FROM found""".replace(
        "$amt$", "'(?i)(?:[A-Z]{3}|[$£\\x{20A0}-\\x{20CF}])[ \\x{A0}\\x{2000}-\\x{2060}]?(?:\\d{1,3}(?:[ ,]\\d{3})*[.,]\\d{2}|\\d+[.,]\\d{2})"
        "|(?:\\d{1,3}(?:[ ,]\\d{3})*[.,]\\d{2}|\\d+[.,]\\d{2})[ \\x{A0}\\x{2000}-\\x{2060}]?(?:[A-Z]{3}|[$£\\x{20A0}-\\x{20CF}])'"),
    "json_first_object": _with(_NOTICES) + """SELECT message_id, ord % 8 <> 6 AS found,
        CASE WHEN ord % 8 NOT IN (5, 6, 7) THEN 'card purchase at ' || entity END AS description FROM notices""",
    "json_nested": _with(_NOTICES) + """SELECT message_id, repeat('{"a":', 3 * cast(left(priority, 1) AS int)) || ord
        || repeat('}', 3 * cast(left(priority, 1) AS int)) AS object FROM notices""",
    "alias_map": _with(_NOTICES) + """SELECT message_id, cast(day AS varchar) AS date,
        CASE ord % 8 WHEN 1 THEN last4 WHEN 2 THEN custkey || '.0' WHEN 4 THEN '' ELSE account END AS account,
        CASE WHEN ord % 8 = 0 THEN institution || ' ATM' ELSE 'Shop 7' END AS external_entity,
        CASE WHEN ord % 8 <> 3 THEN 'ZAR' END AS currency, CASE WHEN ord % 8 = 3 THEN 10 ELSE 11 END AS present
        FROM notices WHERE ord % 8 NOT IN (5, 6)""",
    "schema_projection": _with(_NOTICES) + """SELECT message_id, cast(day AS varchar) AS date, account AS internal_account_number,
        'Shop 7' AS external_entity, cast(amount AS double) AS amount,
        CASE WHEN ord % 16 < 8 THEN cast(balance AS double) END AS available_balance, 'ZAR' AS currency,
        'card purchase at ' || entity AS description, 'alerts@' || lower(institution) || '.example' AS source_email,
        cast(NULL AS varchar) AS run_id FROM notices""",
    "hybrid_parse": _with(_NOTICES, _ACCOUNTS, _ENDINGS, _PARSED) + """SELECT message_id, parse_path, cast(d AS varchar) AS date,
        internal_account_number, internal_entity, institution, external_entity, cast(amount AS double) AS amount,
        cast(available_balance AS double) AS available_balance, currency, description, transaction_type FROM parsed""",
    "parse_reasons": _with(_NOTICES) + """SELECT CASE WHEN ord % 8 IN (0, 1, 2, 7) THEN 'json' WHEN ord % 16 = 6 THEN 'failed' ELSE 'regex' END AS parse_path,
        CASE WHEN ord % 8 IN (0, 1, 2, 7) THEN '' WHEN ord % 8 = 3 THEN 'currency: missing'
          WHEN ord % 8 = 4 THEN 'internal_entity: not allowed|institution: not allowed' ELSE 'no JSON object' END AS errors,
        count(*) AS n FROM notices GROUP BY 1, 2""",
    "unparsed_flags": _with(_NOTICES) + """SELECT 'run-1' AS run_id, message_id, '' AS sender, '' AS subject,
        'All parsers failed' AS reason FROM notices WHERE ord % 16 = 6""",
    # --- validation
    "coerce_types": _with(_NOTICES) + """SELECT message_id, cast(day AS varchar) AS date, cast(amount AS double) AS amount,
        cast(custkey AS varchar) AS account, cast(custkey AS varchar) AS account_of_number FROM notices""",
    "validate_records": _with(_NOTICES) + """SELECT message_id, ord % 8 <> 3 AND ord % 3 <> 0 AS valid,
        array_to_string(list_filter([CASE WHEN ord % 8 = 3 THEN 'currency: missing' END,
          CASE WHEN ord % 3 = 0 THEN 'institution: not allowed' END], lambda x: x IS NOT NULL), '|') AS errors
        FROM notices WHERE ord % 8 NOT IN (5, 6)""",
    "allowed_values": _with(_NOTICES) + """SELECT message_id, true AS entity_allowed, ord % 3 <> 0 AS institution_allowed
        FROM notices WHERE ord % 8 NOT IN (5, 6)""",
    "missing_flags": _with(_LEDGER, _GAPPY, _FLAGS) + "SELECT * FROM flags",
    "flag_log": _with(_LEDGER, _GAPPY, _FLAGS) + "SELECT run_id, reason, count(*) AS n FROM flags GROUP BY 1, 2",
    "blank_nulls": _with(_LEDGER, _GAPPY) + """SELECT message_id, strftime(date, '%Y-%m-%d') AS date, coalesce(currency, '') AS currency,
        description, cast(available_balance AS double) AS available_balance FROM gappy""",
    # --- accounts
    "account_suffix": _with(_NOTICES, _ACCOUNTS, _SUFFIXES) + """SELECT message_id, a AS internal_account_number,
        e AS internal_entity, i AS institution FROM notices LEFT JOIN suffixes ON last4 = suffix""",
    "account_endswith": _with(_NOTICES, _ACCOUNTS, _ENDINGS) + """SELECT message_id, custkey::varchar AS number,
        e AS internal_entity, i AS institution FROM notices LEFT JOIN endings ON custkey::varchar = ending""",
    "transfer_resolve": _with(_NOTICES, _ACCOUNTS, _SUFFIXES) + """, t AS (SELECT *,
          lpad(((custkey * 7 + 3) % 3000)::varchar, 4, '0') AS o4, ord % 3 <> 0 AS transfer FROM notices),
        r AS (SELECT t.*, own.a AS oa, own.e AS oe, own.i AS oi, oth.a AS xa, oth.e AS xe,
          transfer AND own.a IS NOT NULL AND oth.a IS NOT NULL AS ok
          FROM t LEFT JOIN suffixes own ON last4 = own.suffix
          LEFT JOIN suffixes oth ON oth.suffix = o4)
        SELECT message_id, CASE WHEN ok THEN oa ELSE last4 END AS internal_account_number,
          CASE WHEN ok THEN oe ELSE '?' END AS internal_entity, CASE WHEN ok THEN oi ELSE '?' END AS institution,
          CASE WHEN ok THEN xa END AS external_account_number, CASE WHEN ok THEN xe ELSE 'Shop' END AS external_entity FROM r""",
    "merchant_fix": _with(_NOTICES) + """SELECT message_id, CASE WHEN ord % 2 = 1 THEN 'Shop' WHEN ord % 3 = 0 THEN entity || ' at 9'
        WHEN ord % 3 = 1 THEN entity ELSE institution || ' POS' END AS external_entity FROM notices""",
    "owner_class": _with(_NOTICES, _ACCOUNTS, _SUFFIXES) + """, t AS (SELECT message_id, CASE ord % 3 WHEN 0 THEN coalesce(a, last4)
          WHEN 1 THEN account ELSE '9' || account END AS full_number FROM notices LEFT JOIN suffixes ON last4 = suffix)
        SELECT message_id, full_number, coalesce(institution, '') AS owner_institution, coalesce(owner_type, 'unclassified') AS owner_class
        FROM t LEFT JOIN accounts ON full_number = internal_account_number""",
    "duplicate_suffix": _with(_ACCOUNTS) + """, n AS (SELECT internal_account_number || lpad((position % 997)::varchar, 4, '0') AS number FROM accounts)
        SELECT DISTINCT right(number, 4) AS suffix, number FROM n
        WHERE right(number, 4) IN (SELECT right(number, 4) FROM n GROUP BY 1 HAVING count(DISTINCT number) > 1)""",
    # --- ledger
    "new_records_only": _with(_LEDGER) + "SELECT message_id, cast(date AS varchar) AS date, cast(amount AS double) AS amount FROM ledger WHERE NOT amount < 0",
    "known_few_ids": _with(_LEDGER) + "SELECT message_id FROM ledger WHERE amount >= 0 AND cast(internal_account_number AS bigint) <= 10",
    "processed_union": _with(_LEDGER) + "SELECT DISTINCT message_id FROM ledger WHERE amount < 0 OR available_balance IS NOT NULL",
    "batch_dedupe": """SELECT user_id::varchar AS message_id, min(event_id) AS ord, arg_min(event_type, event_id) AS event_type,
        arg_min(value, event_id) AS value, count(*) AS copies FROM events GROUP BY 1""",
    "balance_forward_fill": _fill("NULL"),
    "balance_across_runs": _fill("NULL"),
    "balance_fill_full": _fill("ahead + ahead_amount + s - amount"),
    "balance_fill_ledger": _fill("ahead + s"),
    "account_buckets": _with(_LEDGER) + """SELECT message_id, internal_account_number,
        min(ord) OVER (PARTITION BY internal_account_number) AS bucket_ord FROM ledger""",
    "record_ids": _with(_LEDGER) + """SELECT message_id, 1000 + row_number() OVER (ORDER BY date, bucket_ord, ord) AS record_id FROM (
        SELECT *, min(ord) OVER (PARTITION BY internal_account_number) AS bucket_ord FROM ledger)""",
    "batch_order": _with(_LEDGER) + """SELECT message_id, cast(date AS varchar) AS date,
        min(ord) OVER (PARTITION BY internal_account_number) AS bucket_ord, ord FROM ledger ORDER BY date, bucket_ord, ord""",
    "ordered_merge": _with(_LEDGER, _SIDES) + """SELECT message_id, d AS date, CASE WHEN side = 0 THEN cast(amount AS double) END AS amount
        FROM sides ORDER BY try_cast(d AS date) NULLS FIRST, side, ord""",
    "merge_position": _with(_LEDGER, _SIDES) + """SELECT message_id,
        row_number() OVER (ORDER BY try_cast(d AS date) NULLS FIRST, side, ord) AS pos FROM sides""",
    "ledger_append": _with(_LEDGER, _SIDES) + """SELECT message_id, d AS date,
        CASE WHEN side = 0 THEN cast(amount AS double) END AS amount FROM sides""",
    # --- replicates and fingerprints
    "replicate_match": _with(_LEDGER, _MATCHES) + "SELECT run, message_id, struct_match, id_match FROM matches",
    "match_rates": _with(_LEDGER, _MATCHES, _RATES) + """SELECT run, n, struct_ok, id_ok, struct_ok / n AS p_struct, id_ok / n AS p_id,
        latency_ms FROM rates""",
    "binomial_interval": """WITH RECURSIVE counts AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS s, count(*) AS n FROM events GROUP BY 1), """
        + _interval("counts", "s", "n", "user_id") + "SELECT user_id, s, n, round(pmin, 6) AS pmin, round(pmax, 6) AS pmax FROM ci",
    "replicate_summary": "WITH RECURSIVE " + ", ".join([_LEDGER, _MATCHES, _RATES, _interval("rates", "id_ok", "n", "run")]) + """
        SELECT run, struct_ok / rates.n AS p_struct, struct_ok / rates.n >= 1.0 AS struct_pass, id_ok / rates.n AS p_id,
          round(pmin, 6) AS pmin, round(pmax, 6) AS pmax, pmin >= 0.99 AS id_pass, latency_ms,
          round(stddev_samp(latency_ms) OVER () / avg(latency_ms) OVER (), 9) AS latency_cv,
          stddev_samp(latency_ms) OVER () / avg(latency_ms) OVER () <= 0.05 AS latency_pass
        FROM rates JOIN ci USING (run)""",
    "latency_cv": "SELECT event_type, round(stddev_samp(value) / avg(value), 9) AS cv FROM events GROUP BY 1",
    "replicate_files": _with(_LEDGER, _MATCHES, _RATES) + "SELECT run, n, id_ok, latency_ms FROM rates",
    "table_fingerprint": _fingerprint("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "ledger_manifest": _with(_LEDGER) + _fingerprint("ledger", ["message_id", "ord", "internal_account_number", "run_id"]),
    "folder_fingerprint": f"""SELECT sum(n_rows)::bigint AS n_rows, sha256(string_agg(fingerprint, chr(10) ORDER BY name)) AS fingerprint FROM (
        SELECT 'benchmark' AS name, * FROM ({_fingerprint('benchmark', ['item_id', 'text'])})
        UNION ALL SELECT 'conversations', * FROM ({_fingerprint('conversations', ['conv_id', 'turn', 'role', 'text'])})
        UNION ALL SELECT 'labels', * FROM ({_fingerprint('labels', ['doc_id', 'quality', 'toxic'])}))""",
    "text_digest": "SELECT doc_id, sha256(text) AS digest FROM documents",
    "canonical_order": "SELECT conv_id, role, text, turn FROM conversations ORDER BY ALL",
    "run_log_update": _with(_RUNS) + """SELECT run_id, success AS processed_transactions,
        CASE WHEN success / (success + failed) < 0.8 THEN sha256(run_id) ELSE '' END AS run_hash,
        CASE WHEN success / (success + failed) < 0.8 THEN 'c' ELSE '' END AS config_hash FROM runs""",
    # --- monitors
    "daily_counts": "SELECT cast(cast(ts AS date) AS varchar) AS date, count(*) AS tx_count FROM events GROUP BY 1",
    "zscore_global": """WITH daily AS (SELECT cast(ts AS date) AS date, count(*) AS tx_count FROM events GROUP BY 1)
        SELECT cast(date AS varchar) AS date, tx_count,
          round((tx_count - avg(tx_count) OVER ()) / nullif(stddev_pop(tx_count) OVER (), 0), 6) AS z FROM daily""",
    "zscore_trailing30": _with(_LEDGER, _DAILY_ORDERS, _TRAILING) + """SELECT cast(date AS varchar) AS date, tx_count,
        round(CASE WHEN sd > 0 THEN (tx_count - m) / sd END, 6) AS z FROM scored""",
    "zscore_outliers": _with(_LEDGER, _DAILY_ORDERS, _TRAILING) + """SELECT cast(date AS varchar) AS date, tx_count FROM scored
        WHERE sd > 0 AND abs((tx_count - m) / sd) > 3""",
    "run_rates": _with(_RUNS) + "SELECT run_id, success, failed, success / (success + failed) AS rate FROM runs",
    "last_n_runs": _with(_RUNS) + "SELECT run_id, success, failed FROM runs ORDER BY run_id DESC LIMIT 7",
    "p_chart": "WITH RECURSIVE " + ", ".join([_RUNS, """recent AS (SELECT *, success / (success + failed) AS p, success + failed AS total
          FROM runs ORDER BY run_id DESC LIMIT 20)""",
        "latest AS (SELECT * FROM recent ORDER BY run_id DESC LIMIT 1)",
        _interval("latest", "success", "total", "run_id"),
        """chart AS (SELECT count(*) AS runs, avg(p) AS mu, avg(sqrt(p * (1 - p) / total)) AS sigma FROM recent)"""]) + """
        SELECT runs, round(mu, 6) AS mean_rate, round(p, 6) AS last_rate, round(mu - 3 * sigma, 6) AS lcl, round(mu + 3 * sigma, 6) AS ucl,
          round(pmin, 6) AS ci_low, round(pmax, 6) AS ci_high,
          CASE WHEN p > mu + 3 * sigma OR p < mu - 3 * sigma OR NOT (mu BETWEEN pmin AND pmax) THEN 'ALERT' ELSE 'OK' END AS status
        FROM chart, latest, ci""",
    "run_summary": _with(_LEDGER) + """SELECT 'run-1' AS run_id, count(*) AS fetched, count(*) FILTER (ord % 16 <> 6) AS parsed,
        count(*) FILTER (ord % 10 = 0) AS duplicate, count(*) FILTER (ord % 16 = 6) AS failed,
        count(*) FILTER (ord % 16 <> 6 AND ord % 10 <> 0) AS written,
        cast(max(date) FILTER (ord % 16 <> 6 AND ord % 10 <> 0) AS varchar) AS last_transaction FROM ledger""",
    # --- sinks
    "snapshot_roundtrip": _with(_LEDGER) + "SELECT run_id, count(*) AS n, cast(sum(amount) AS double) AS total FROM ledger GROUP BY 1",
    "run_csv_export": _with(_LEDGER, _GAPPY) + """SELECT message_id, cast(date AS varchar) AS date, coalesce(currency, '') AS currency,
        cast(amount AS double) AS amount FROM gappy""",
    "run_meta_roundtrip": _with(_RUNS) + """SELECT run_id, run_id AS timestamp, sha256(run_id) AS run_hash, success, failed,
        1.5::double AS latency_sec FROM runs""",
    "run_log_roundtrip": _with(_RUNS) + """SELECT run_id, run_id AS run_timestamp, success + failed AS fetched_messages,
        success AS processed_transactions, cast(NULL AS varchar) AS run_hash FROM runs""",
    "run_metadata_row": _with(_LEDGER, _GAPPY, _FLAGS) + f"""SELECT 'run-1' AS run_id, f.fingerprint AS run_hash, 1::bigint AS success,
        (SELECT count(*) FROM flags) AS failed, 0.5::double AS latency_sec
        FROM ({_fingerprint("(SELECT message_id, ord FROM ledger)", ["message_id", "ord"])}) f""",
    # --- whole run
    "ledger_run": _with(_NOTICES, _ACCOUNTS, _ENDINGS, _PARSED, _LEDGER_RUN, """summed AS (SELECT *,
        coalesce(amount, 0) AS a, coalesce(internal_account_number, '') AS acc FROM good),
      running AS (SELECT *, sum(a) OVER (PARTITION BY acc ORDER BY d NULLS FIRST, ord ROWS UNBOUNDED PRECEDING) AS s FROM summed),
      filled AS (SELECT *,
        last_value(available_balance - s IGNORE NULLS) OVER (PARTITION BY acc ORDER BY d NULLS FIRST, ord ROWS UNBOUNDED PRECEDING) AS back,
        first_value(available_balance - s + a IGNORE NULLS) OVER (PARTITION BY acc ORDER BY d NULLS FIRST, ord
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM running)""") + """SELECT message_id, ord, cast(d AS varchar) AS date,
        filled.internal_account_number, internal_entity, institution, external_entity, cast(amount AS double) AS amount,
        cast(coalesce(available_balance, back + s, ahead + s - a) AS double) AS available_balance, currency, description,
        transaction_type, source_email, row_number() OVER (ORDER BY d NULLS FIRST, bucket_ord, ord) AS record_id, 'run-1' AS run_id
        FROM filled JOIN firsts ON filled.internal_account_number IS NOT DISTINCT FROM firsts.internal_account_number""",
    "ledger_run_summary": _with(_NOTICES, _ACCOUNTS, _ENDINGS, _PARSED) + """SELECT 'run-1' AS run_id, 2 * count(*) AS fetched,
        count(*) FILTER (parse_path <> 'failed') AS parsed, count(*) AS duplicate,
        count(*) FILTER (parse_path = 'failed') AS failed, count(*) FILTER (parse_path <> 'failed') AS written,
        cast(max(d) AS varchar) AS last_transaction FROM parsed""",
    # --- streaming
    "stream_incremental": _with(_NOTICES, _ACCOUNTS, _ENDINGS, _PARSED, _LEDGER_RUN) + """SELECT message_id, cast(d AS varchar) AS date,
        good.internal_account_number, external_entity, cast(amount AS double) AS amount,
        row_number() OVER (ORDER BY d NULLS FIRST, bucket_ord, ord) AS record_id
        FROM good JOIN firsts ON good.internal_account_number IS NOT DISTINCT FROM firsts.internal_account_number""",
    "stream_arrivals": _with(_NOTICES, _ACCOUNTS, _ENDINGS, _PARSED, _LEDGER_RUN) + """SELECT message_id, cast(d AS varchar) AS date,
        good.internal_account_number, external_entity, cast(amount AS double) AS amount,
        row_number() OVER (ORDER BY d NULLS FIRST, bucket_ord, ord) AS record_id
        FROM good JOIN firsts ON good.internal_account_number IS NOT DISTINCT FROM firsts.internal_account_number""",
    "stream_overlap_dedupe": "SELECT event_id, user_id, value FROM events",
    # --- plug-ins
    "parser_plugin": _with(_NOTICES) + """SELECT message_id, CASE WHEN ord % 8 IN (5, 6) THEN 'text' ELSE 'json' END AS parser,
        CASE ord % 8 WHEN 0 THEN institution || ' ATM' WHEN 5 THEN entity || ' Ltd' WHEN 6 THEN 'Shop ' || entity ELSE 'Shop 7' END AS external_entity
        FROM notices WHERE ord % 16 <> 6""",
    "generation_hook": _with(_NOTICES) + """SELECT message_id, CASE ord % 4 WHEN 0 THEN 'Available balance: ZAR ' || balance
        WHEN 1 THEN 'New balance ' || balance WHEN 2 THEN 'Shop ' || entity
        ELSE 'Dear ' || entity || ', your card ****' || last4 || ' is active.' END AS description FROM notices""",
    "plugin_stream": "SELECT o_orderkey AS id, o_custkey AS account, o_orderpriority AS priority FROM orders",
    "source_plugin": "SELECT o_orderkey AS id, o_custkey AS account, o_orderpriority AS priority FROM orders",
}
