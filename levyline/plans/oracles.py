"""The registered queries as plain SQL over the input tables, for checking results in another engine."""

from __future__ import annotations

from levyline.functions.text import WHITE
from levyline.functions.vectors import LETTERS
from levyline.operators.analytics import FRAUD_WORDS
from levyline.operators.audit import ACTORS
from levyline.sources import testdata as data

EVENTS = {"events": "events", "documents": "documents"}

BASE = {
    "filings": data.FILINGS_SQL.format(**EVENTS),
    "profiles": data.PROFILES_SQL.format(**EVENTS),
    "signals": data.SIGNALS_SQL.format(**EVENTS),
    "audit_events": data.AUDIT_SQL.format(**EVENTS),
    "run_events": data.RUN_EVENTS_SQL.format(**EVENTS),
    "markdown_files": data.MARKDOWN_SQL.format(**EVENTS),
}


def stamp(column: str) -> str:
    return f"TRY_CAST(replace(substring({column}, 1, 19), 'T', ' ') AS TIMESTAMP)"


def strip(value: str) -> str:
    return f"trim({value}, '{WHITE}')"


def bucket(column: str, seconds: int) -> str:
    """Start of the time bucket."""
    return f"make_timestamp(CAST(epoch({column}) AS BIGINT) // {seconds} * {seconds} * 1000000)"


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


def cents(column: str) -> str:
    return f"CAST(CAST(sum(CAST({column} AS DECIMAL(20,2))) * 100 AS DECIMAL(38,0)) AS HUGEINT)"


def half_up(part: str, whole: str) -> str:
    """part / whole rounded half away from zero, in integers."""
    return f"(CASE WHEN ({part}) < 0 THEN -1 ELSE 1 END * ((2 * abs({part}) + ({whole})) // (2 * ({whole}))))"


def mean(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(20,2))) AS DOUBLE) / count({column})"


FRAUDS = "count(*) FILTER (WHERE is_fraud)"

BASE["timed"] = f"SELECT *, {stamp('_produced_at')} AS event_time FROM filings"
BASE["clean"] = f"""
SELECT trim(application_id) AS application_id, trim(customer_id) AS customer_id, trim(customer_name) AS customer_name,
       lower(trim(email)) AS email, upper(trim(country)) AS country, upper(trim(province)) AS province, taxable_income,
       upper(trim(employment_type)) AS employment_type, upper(trim(employment_status)) AS employment_status,
       substring(trim(submitted_date), 1, 10) AS submitted_date, trim(tax_year) AS tax_year,
       upper(trim(filing_status)) AS filing_status, is_fraud,
       replace(substring(_produced_at, 1, 19), 'T', ' ') AS produced_at,
       substring(trim(submitted_date), 1, 10) AS dt, {stamp('_produced_at')} AS event_time
FROM filings
WHERE application_id IS NOT NULL AND customer_id IS NOT NULL AND taxable_income >= 0
      AND length(trim(submitted_date)) >= 10"""
BASE["typed"] = f"""
SELECT trim(application_id) AS application_id, trim(customer_id) AS customer_id, trim(customer_name) AS customer_name,
       lower(trim(email)) AS email, upper(trim(country)) AS country, upper(trim(province)) AS province,
       CAST(CAST(taxable_income AS DECIMAL(15,2)) AS DOUBLE) AS taxable_income,
       upper(trim(employment_type)) AS employment_type, upper(trim(employment_status)) AS employment_status,
       CASE WHEN length(trim(submitted_date)) = 4 THEN concat(trim(submitted_date), '-01-01')
            ELSE substring(trim(submitted_date), 1, 10) END AS submitted_date,
       trim(tax_year) AS tax_year, upper(trim(filing_status)) AS filing_status, is_fraud, event_time
FROM timed"""
BASE["known"] = f"SELECT *, {stamp('_produced_at')} AS p_time FROM profiles"


def windows(source: str, seconds: int, having: str = "") -> str:
    return f"""
SELECT w AS window_start, w + INTERVAL {seconds} SECONDS AS window_end, count(*) AS total_count,
       {mean('taxable_income')} AS avg_income, count(DISTINCT customer_id) AS distinct_customers,
       {FRAUDS} AS fraud_count, CAST({FRAUDS} AS DOUBLE) / count(*) AS fraud_rate, max(province) AS top_province
FROM (SELECT *, {bucket('event_time', seconds)} AS w FROM {source}) GROUP BY w {having}"""


BASE["kpis"] = windows("clean", 300)
BASE["cache_input"] = f"""
SELECT w AS window_start, w + INTERVAL 5 MINUTES AS window_end, count(*) AS n, {cents('taxable_income')} AS s,
       count(taxable_income) AS sn, count(DISTINCT customer_id) AS customers, {FRAUDS} AS f, max(province) AS p
FROM (SELECT *, {bucket('event_time', 300)} AS w FROM clean) GROUP BY w"""


def high_frequency(minutes: int) -> str:
    start = f"strftime(w, '%Y-%m-%dT%H:%M:%S')"
    return f"""
SELECT 'flink-hf-' || {start} || '-' || customer_id AS signal_id, 'MULTIPLE' AS application_id, customer_id,
       'HIGH_FREQUENCY_SUBMISSIONS' AS signal_type, 'HIGH' AS severity, {start} AS detected_at,
       'Customer submitted ' || count(*) || ' applications in {minutes}-min window starting '
       || strftime(w, '%Y-%m-%d %H:%M:%S') AS description
FROM (SELECT *, {bucket('event_time', minutes * 60)} AS w FROM timed) GROUP BY customer_id, w HAVING count(*) >= 3"""


SPIKES = """
SELECT 'flink-spike-' || trim(application_id) AS signal_id, trim(application_id) AS application_id,
       trim(customer_id) AS customer_id, 'INCOME_SPIKE' AS signal_type, 'MEDIUM' AS severity,
       replace(substring(_produced_at, 1, 19), 'T', ' ') AS detected_at,
       'Taxable income R' || CAST(CAST(taxable_income AS DECIMAL(15,2)) AS VARCHAR)
       || ' exceeds high-value threshold of R500,000' AS description
FROM filings WHERE taxable_income > 500000"""
BASE["high_frequency"] = high_frequency(1440)
BASE["spikes"] = SPIKES
BASE["every_signal"] = """
SELECT * FROM signals UNION ALL SELECT * FROM high_frequency UNION ALL SELECT * FROM spikes"""


def normal_form(source: str) -> str:
    return f"""
SELECT trim(signal_id) AS detection_id, coalesce(trim(application_id), 'UNKNOWN') AS application_id,
       coalesce(trim(customer_id), 'UNKNOWN') AS customer_id, upper(coalesce(trim(signal_type), 'UNKNOWN')) AS signal_type,
       CASE WHEN upper(trim(severity)) IN ('LOW', 'MEDIUM', 'CRITICAL') THEN upper(trim(severity)) ELSE 'HIGH' END AS severity,
       'FLINK' AS source, coalesce(trim(description), 'No description') AS description,
       {stamp("coalesce(detected_at, '2000-01-01T00:00:00')")} AS detected_at
FROM {source} WHERE signal_id IS NOT NULL AND customer_id IS NOT NULL"""


BASE["detections"] = normal_form("every_signal")
BASE["recent100"] = "SELECT * FROM detections ORDER BY detected_at DESC NULLS LAST, detection_id LIMIT 100"
BASE["audit"] = f"""
SELECT trim(event_id) AS event_id, trim(application_id) AS application_id, actor, action,
       {stamp('timestamp')} AS event_timestamp,
       CASE WHEN json_valid(metadata) THEN metadata END AS metadata
FROM audit_events WHERE event_id IS NOT NULL"""
BASE["ml"] = """
SELECT application_id, customer_id, coalesce(province, 'UNKNOWN') AS province, taxable_income,
       coalesce(employment_type, 'UNKNOWN') AS employment_type, coalesce(employment_status, 'UNKNOWN') AS employment_status,
       coalesce(filing_status, 'UNKNOWN') AS filing_status, coalesce(is_fraud, false) AS is_fraud
FROM clean"""
BASE["scored"] = """
SELECT application_id, taxable_income / 2000000 + CASE WHEN filing_status = 'AMENDED' THEN 0.125 ELSE CAST(0 AS DOUBLE) END AS score,
       CAST(is_fraud AS INT) AS label FROM clean"""
BASE["curve"] = """
SELECT threshold, CAST(sum(n) OVER w AS BIGINT) AS flagged, CAST(sum(pos) OVER w AS BIGINT) AS tp, pos, sum(pos) OVER () AS positives
FROM (SELECT score AS threshold, count(*) AS n, count(*) FILTER (WHERE label = 1) AS pos FROM scored GROUP BY score)
WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)"""
BASE["rated"] = """
SELECT threshold, flagged, tp, pos, positives, CAST(tp AS DOUBLE) / flagged AS precision, CAST(tp AS DOUBLE) / positives AS recall,
       CAST(2 AS DOUBLE) * (CAST(tp AS DOUBLE) / flagged) * (CAST(tp AS DOUBLE) / positives)
       / greatest(CAST(tp AS DOUBLE) / flagged + CAST(tp AS DOUBLE) / positives, 1e-12) AS f1
FROM curve"""
BASE["cells"] = """
SELECT count(*) FILTER (WHERE score >= 0.25 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.25 AND label = 0) AS fp,
       count(*) FILTER (WHERE score < 0.25 AND label = 1) AS fn, count(*) FILTER (WHERE score < 0.25 AND label = 0) AS tn
FROM scored"""
BASE["trials"] = """
SELECT family, label, CASE WHEN score > 0 THEN score END AS score, cv_f1 FROM (
  SELECT employment_type AS family, concat(filing_status, '/', coalesce(province, 'none')) AS label,
         CAST(count(*) FILTER (WHERE is_fraud) AS DOUBLE) / count(*) AS score,
         CAST(count(*) FILTER (WHERE taxable_income > 100000) AS DOUBLE) / count(*) AS cv_f1
  FROM clean GROUP BY 1, 2)"""
BASE["cases"] = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label >= 5 AS is_fraud, label FROM embeddings"
BASE["centroids"] = """
SELECT label, list(m ORDER BY pos) AS c FROM (
  SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM cases) GROUP BY label, pos)
GROUP BY label"""
BASE["alike"] = """
SELECT * FROM (
  SELECT q.label, vec_id, is_fraud, sim AS similarity, row_number() OVER (PARTITION BY q.label ORDER BY sim DESC, vec_id) AS rank
  FROM (SELECT centroids.label, vec_id, is_fraud, round(list_cosine_similarity(v, c), 6) AS sim FROM cases, centroids) q)
WHERE rank <= 5"""
PROFILE = "[" + ", ".join(f"length(t) - length(replace(t, '{c}', ''))" for c in LETTERS) + "]"
BASE["questions"] = f"""
SELECT question_id, CAST({PROFILE} AS DOUBLE[]) AS v FROM (
  SELECT conv_id * 1000 + turn AS question_id, lower(coalesce(text, '')) AS t FROM conversations WHERE role = 'user')"""
BASE["knowledge"] = f"""
SELECT chunk, file, section, source, status, text, CAST({PROFILE} AS DOUBLE[]) AS v FROM (
  SELECT item_id AS chunk, concat('file-', item_id % 5, '.md') AS file, concat('item ', item_id) AS section,
         'benchmark' AS source, 'checked' AS status, text, lower(coalesce(text, '')) AS t FROM benchmark)"""


def kb_hits(source: str, k: int) -> str:
    norm = "list_sum(list_transform({0}, lambda x: x * x))"
    safe = (
        f"CASE WHEN {norm.format('q.v')} = 0 OR {norm.format('c.v')} = 0 THEN 0.0 "
        "ELSE list_cosine_similarity(q.v, c.v) END"
    )
    return f"""
SELECT * FROM (SELECT question_id, chunk, sim AS similarity,
                      row_number() OVER (PARTITION BY question_id ORDER BY sim DESC, chunk) AS rank
               FROM (SELECT question_id, chunk, round({safe}, 6) AS sim FROM questions q, {source} c))
WHERE rank <= {k}"""


BASE["expected_jobs"] = """
SELECT DISTINCT CASE event_type WHEN 'view' THEN 'mlflow' WHEN 'error' THEN 'postgres' ELSE 'flink' END AS namespace,
       concat('job_', event_type, '_', user_id % 12) AS job_name FROM events"""
BASE["sets"] = """
SELECT namespace, dataset, max(event_time) AS updated_at FROM (
  SELECT 'kafka' AS namespace, input_a AS dataset, event_time FROM run_events
  UNION ALL SELECT 'minio', input_b, event_time FROM run_events
  UNION ALL SELECT 'postgres', output_a, event_time FROM run_events) GROUP BY 1, 2"""
BASE["blocks"] = """
SELECT file, a AS text, unnest(string_split(concat(chr(10), a), concat(chr(10), '## '))) AS block,
       generate_subscripts(string_split(concat(chr(10), a), concat(chr(10), '## ')), 1) - 1 AS position
FROM (SELECT file, text AS a FROM markdown_files WHERE lower(file) <> 'readme.md')"""


def line(text: str, name: str) -> str:
    return strip(f"regexp_extract({text}, '(?m)^{name}:\\s*(.+)$', 1)")


TITLE = strip("string_split(block, chr(10))[1]")
BODY = "CASE WHEN contains(block, chr(10)) THEN " + strip("substring(block, instr(block, chr(10)) + 1)") + " ELSE '' END"
BASE["parts"] = f"""
SELECT file, {line('text', 'Authority')} AS authority, position, {TITLE} AS section, {BODY} AS body
FROM blocks WHERE position > 0"""


def with_tables(sql: str) -> str:
    """The statement with the derived tables it uses, in dependency order."""
    import re

    used: list[str] = []

    def add(text: str):
        for name in BASE:
            if name not in used and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                add(BASE[name])
                if name not in used:
                    used.append(name)

    add(sql)
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({BASE[name]})" for name in used) + "\n" + sql


CLEAN_COLUMNS = (
    "application_id, customer_id, customer_name, email, country, province, taxable_income, employment_type, "
    "employment_status, submitted_date, tax_year, filing_status, is_fraud, produced_at, dt"
)
TYPED = (
    "a.application_id, a.customer_id, a.customer_name, a.email, a.country, a.province, a.taxable_income, a.employment_type, "
    "a.employment_status, a.submitted_date, a.tax_year, a.filing_status, a.is_fraud"
)
FILLED = (
    "coalesce(p.age, 0) AS age, CAST(CAST(coalesce(p.risk_score, 0) AS DECIMAL(5,4)) AS DOUBLE) AS risk_score, "
    "coalesce(p.historical_filings_count, 0) AS historical_filings_count, "
    "CAST(CAST(coalesce(p.avg_income_3yr, 0) AS DECIMAL(15,2)) AS DOUBLE) AS avg_income_3yr, "
    "coalesce(p.flagged_previously, false) AS flagged_previously"
)
HOUR = "p.customer_id = a.customer_id AND p.p_time BETWEEN a.event_time - INTERVAL 1 HOUR AND a.event_time + INTERVAL 1 HOUR"
ASOF = f"""
SELECT * EXCLUDE (r) FROM (
  SELECT {TYPED}, {FILLED}, row_number() OVER (PARTITION BY a.application_id ORDER BY p.p_time DESC NULLS LAST) AS r
  FROM typed a LEFT JOIN known p ON p.customer_id = a.customer_id AND p.p_time <= a.event_time) WHERE r = 1"""

TWO = "CAST({} AS DOUBLE) / 100"
SEVERITY = "CASE WHEN taxable_income > 500000 THEN 'HIGH' ELSE 'MEDIUM' END"
RISK = "CASE WHEN {0} >= 0.75 THEN 'HIGH' WHEN {0} >= 0.45 THEN 'MEDIUM' ELSE 'LOW' END"
CEILING = (
    "CASE employment_type WHEN 'EMPLOYED' THEN 650000 WHEN 'SELF_EMPLOYED' THEN 900000 WHEN 'CONTRACTOR' THEN 750000 "
    "WHEN 'UNEMPLOYED' THEN 30000 ELSE 650000 END"
)
FEATURES = (
    f"application_id, province, employment_type, employment_status, filing_status, taxable_income, "
    f"taxable_income / {CEILING} AS income_ratio, CAST(taxable_income / {CEILING} > 1 AS DOUBLE) AS above_ceiling, "
    "CAST(filings AS DOUBLE) AS customer_filings, round(ln(1 + taxable_income), 6) AS log_income"
)


def fixed(number: str, digits: int) -> str:
    unit = 10 ** digits
    whole = f"abs({number})"
    sign = f"CASE WHEN ({number}) < 0 THEN '-' ELSE '' END"
    return f"concat({sign}, CAST({whole} // {unit} AS VARCHAR), '.', lpad(CAST({whole} % {unit} AS VARCHAR), {digits}, '0'))"


CACHE = f"""
SELECT concat('tax:kpi:window:', {iso('window_start')}) AS cache_key, {iso('window_start')} AS window_start,
       {iso('window_end')} AS window_end, CAST(n AS VARCHAR) AS total_count, {fixed(half_up('s', 'sn'), 2)} AS avg_income,
       CAST(customers AS VARCHAR) AS distinct_customers, CAST(f AS VARCHAR) AS fraud_count,
       {fixed(half_up('f * 10000', 'n'), 4)} AS fraud_rate, coalesce(p, 'UNKNOWN') AS top_province
FROM (SELECT * FROM cache_input ORDER BY window_start DESC LIMIT 20)"""

NEWEST_DAYS = "(SELECT min(dt) FROM (SELECT DISTINCT dt FROM clean ORDER BY dt DESC LIMIT 7))"
METADATA = ", ".join(
    f"CASE WHEN metadata IS NOT NULL THEN json_extract_string(metadata, '$.{f}') END AS {f}"
    for f in ("customer_id", "channel", "trigger_reason", "validation_rule")
)
REFUND = "CASE WHEN metadata IS NOT NULL THEN TRY_CAST(json_extract_string(metadata, '$.refund_amount') AS DOUBLE) END"
ACTOR = "CASE " + " ".join(
    f"WHEN action IN ({', '.join(repr(a) for a in actions)}) THEN '{kind}'" for kind, actions in ACTORS.items()
) + " END"


def uuid5(name: str) -> str:
    h = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    variant = f"substring('89ab', 1 + (strpos('0123456789abcdef', substring({h}, 17, 1)) - 1) % 4, 1)"
    return (
        f"concat(substring({h}, 1, 8), '-', substring({h}, 9, 4), '-5', substring({h}, 14, 3), '-', {variant}, "
        f"substring({h}, 18, 3), '-', substring({h}, 21, 12))"
    )


def pick(name: str, meets: str, primary: str) -> str:
    point = "{'t': threshold, 'p': precision, 'r': recall, 'f': f1}"
    best = f"(SELECT {point} FROM rated WHERE {meets} ORDER BY {primary} + 1e-6 * f1 DESC, threshold LIMIT 1)"
    free = f"(SELECT {point} FROM rated ORDER BY f1 + 1e-6 * f1 DESC, threshold LIMIT 1)"
    return f"""SELECT '{name}' AS objective, coalesce({best}, {free}) AS x,
        (SELECT count(*) FROM rated WHERE {meets}) > 0 AS feasible"""


def div0(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


ROUTED = "CASE WHEN " + " OR ".join(f"contains(lower(text), '{w}')" for w in FRAUD_WORDS) + " THEN 'fraud_check' ELSE 'tax_question' END"
HEADER = (
    "concat('[Source ', rank, ': ', file, ' - ', section, ' | origin: ', source, ' | status: ', status, ']', chr(10), text)"
)
STATE = "CASE event_type WHEN 'START' THEN 'RUNNING' WHEN 'COMPLETE' THEN 'COMPLETED' ELSE 'FAILED' END"
LAST_RUN = "row_number() OVER (PARTITION BY namespace, job_name ORDER BY event_time DESC, run_id DESC)"

STATEMENTS = {
    "kpi_tumbling_5m": "SELECT * FROM kpis",
    "kpi_raw_tumbling_5m": windows("timed", 300),
    "sliding_kpi": f"""
        SELECT w AS window_start, w + INTERVAL 10 MINUTES AS window_end, count(*) AS total_count, {mean('taxable_income')} AS avg_income,
               count(DISTINCT customer_id) AS distinct_customers, {FRAUDS} AS fraud_count,
               CAST({FRAUDS} AS DOUBLE) / count(*) AS fraud_rate, max(province) AS top_province
        FROM (SELECT *, {bucket('event_time', 300)} AS w FROM clean
              UNION ALL SELECT *, {bucket('event_time', 300)} - INTERVAL 5 MINUTES AS w FROM clean) GROUP BY w""",
    "clean_applications": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "dq_rejects": """
        SELECT * FROM (SELECT CASE WHEN application_id IS NULL THEN 'missing_application_id'
               WHEN customer_id IS NULL THEN 'missing_customer_id' WHEN taxable_income IS NULL THEN 'missing_income'
               WHEN taxable_income < 0 THEN 'negative_income' WHEN length(trim(submitted_date)) < 10 THEN 'short_date' END AS reject_reason,
               count(*) AS n FROM filings GROUP BY 1) WHERE reject_reason IS NOT NULL""",
    "raw_archive_counts": "SELECT substring(submitted_date, 1, 10) AS dt, count(*) AS n FROM filings GROUP BY 1",
    "decode_status": """
        SELECT status, count(*) AS n, count(*) FILTER (WHERE status <> 'not_json') AS with_id,
               count(*) FILTER (WHERE status = 'ok') AS with_flag
        FROM (SELECT CASE WHEN event_id % 113 = 0 THEN 'not_json' WHEN event_id % 127 = 0 THEN 'bad_field' ELSE 'ok' END AS status
              FROM events WHERE event_type <> 'view') GROUP BY 1""",
    "unreadable_stamps": f"SELECT event_id, timestamp FROM audit_events WHERE {stamp('timestamp')} IS NULL",
    "enrich_interval_left": f"SELECT {TYPED}, {FILLED} FROM typed a LEFT JOIN known p ON {HOUR}",
    "enrich_one_per_application": f"""
        SELECT * EXCLUDE (r) FROM (
          SELECT {TYPED}, {FILLED}, row_number() OVER (PARTITION BY a.application_id
                 ORDER BY abs(epoch(p.p_time) - epoch(a.event_time)) NULLS LAST, p.p_time DESC) AS r
          FROM typed a LEFT JOIN known p ON {HOUR}) WHERE r = 1""",
    "asof_profile": f"""
        SELECT application_id, customer_id, age, risk_score, historical_filings_count, avg_income_3yr, flagged_previously
        FROM ({ASOF})""",
    "income_vs_avg3yr": f"""
        SELECT application_id, taxable_income, avg_income_3yr FROM ({ASOF})
        WHERE avg_income_3yr > 0 AND taxable_income > 3 * avg_income_3yr""",
    "label_24h": f"""
        SELECT application_id, CAST(EXISTS (
            SELECT 1 FROM (SELECT customer_id, {stamp('detected_at')} AS t FROM signals) s
            WHERE s.customer_id = trim(a.customer_id) AND s.t BETWEEN a.event_time - INTERVAL 24 HOURS AND a.event_time + INTERVAL 24 HOURS
          ) AS INT) AS label FROM timed a""",
    "high_frequency_signals": "SELECT * FROM high_frequency",
    "income_spike_signals": "SELECT * FROM spikes",
    "signals_union": "SELECT signal_type, severity, count(*) AS n FROM every_signal GROUP BY 1, 2",
    "normalise_signals": normal_form("signals"),
    "signal_domain_checks": """
        SELECT 'severity' AS column_name, count(*) AS checked,
               count(*) FILTER (WHERE upper(trim(severity)) NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) AS violations FROM signals
        UNION ALL SELECT 'source', count(*), 0 FROM signals""",
    "kpi_trend": "SELECT window_start, total_count, avg_income, fraud_count, fraud_rate FROM kpis ORDER BY window_start DESC LIMIT 24",
    "fraud_summary": f"""
        SELECT employment_type AS signal_type, {SEVERITY} AS severity, province, count(*) AS count FROM clean WHERE is_fraud
        GROUP BY 1, 2, 3 ORDER BY count(*) DESC, 1, 2, province NULLS LAST LIMIT 200""",
    "fraud_summary_bucketed": f"""
        SELECT {bucket('event_time', 86400)} AS window_start, employment_type AS signal_type, {SEVERITY} AS severity, province,
               count(*) AS count FROM clean WHERE is_fraud GROUP BY 1, 2, 3, 4""",
    "income_histogram": """
        SELECT CAST(round(mn + i * (mx - mn) / 20) AS BIGINT) AS min_income, CAST(round(mn + (i + 1) * (mx - mn) / 20) AS BIGINT) AS max_income,
               concat(CAST(round(mn + i * (mx - mn) / 20 / 1000) AS BIGINT), 'k-', CAST(round(mn + (i + 1) * (mx - mn) / 20 / 1000) AS BIGINT), 'k') AS bucket_label,
               count(*) AS count
        FROM (SELECT floor((taxable_income - mn) / nullif(mx - mn, 0) * 20) AS i, mn, mx FROM clean,
              (SELECT min(taxable_income) AS mn, max(taxable_income) AS mx FROM clean WHERE taxable_income >= 0) b)
        GROUP BY i, mn, mx""",
    "top_flagged_customers": f"""
        SELECT customer_id, count(*) AS fraud_count, {TWO.format(half_up(cents('taxable_income'), 'count(*)'))} AS avg_income,
               string_agg(DISTINCT province, ', ' ORDER BY province) AS provinces
        FROM clean WHERE is_fraud GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 10""",
    "province_heatmap": f"""
        SELECT coalesce(province, 'UNKNOWN') AS province, count(*) AS total_applications, {FRAUDS} AS fraud_count,
               CAST({half_up(FRAUDS + ' * 10000', 'count(*)')} AS DOUBLE) / 10000 AS fraud_rate,
               {TWO.format(half_up(cents('taxable_income'), 'count(*)'))} AS avg_income
        FROM clean GROUP BY clean.province""",
    "top_provinces": f"""
        SELECT coalesce(province, 'UNKNOWN') AS province, {FRAUDS} AS fraud_count FROM clean GROUP BY clean.province
        ORDER BY fraud_count DESC, 1 LIMIT 9""",
    "fraud_by_province_view": """
        SELECT upper(trim(f.province)) AS province, count(DISTINCT detection_id) AS total_signals,
               count(DISTINCT d.customer_id) AS flagged_customers, count(*) FILTER (WHERE severity = 'HIGH') AS high_count,
               count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count,
               avg(CAST(length(detection_id) % 4 * 0.25 AS DOUBLE)) AS avg_fraud_probability, max(detected_at) AS latest_detection
        FROM detections d LEFT JOIN filings f ON d.application_id = f.application_id GROUP BY upper(trim(f.province))""",
    "signals_by_type": "SELECT signal_type, count(*) AS count FROM detections GROUP BY 1",
    "severity_cards": """
        SELECT count(*) AS total_signals, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
               count(*) FILTER (WHERE severity = 'HIGH') AS high FROM recent100""",
    "recent_signals": """
        SELECT application_id, customer_id, signal_type, severity, strftime(detected_at, '%Y-%m-%d %H:%M:%S') AS detected_at, description
        FROM recent100""",
    "customer_signal_top10": """
        SELECT customer_id, count(signal_type) AS signal_count, max(detected_at) AS latest_signal FROM detections
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "latest_kpi": "SELECT * FROM kpis ORDER BY window_start DESC LIMIT 1",
    "last_windows": "SELECT * FROM kpis ORDER BY window_start DESC LIMIT 12",
    "kpi_cache_rows": CACHE,
    "kpi_latest_summary": f"""
        SELECT 'tax:kpi:latest' AS cache_key, window_start, total_count, avg_income, fraud_rate, top_province
        FROM ({CACHE}) ORDER BY window_start DESC LIMIT 1""",
    "kpi_cache_unexpired": f"""
        SELECT concat('tax:kpi:window:', {iso('window_start')}) AS cache_key, window_end + INTERVAL 900 SECONDS AS expires_at
        FROM kpis WHERE window_end + INTERVAL 900 SECONDS > (SELECT max(window_start) FROM kpis) + INTERVAL 10 MINUTES""",
    "alert_flags": f"""
        SELECT concat('tax:fraud:alert:', customer_id) AS cache_key, 'HIGH' AS value, max(event_time) AS scored_at,
               max(event_time) + INTERVAL 1800 SECONDS AS expires_at
        FROM clean WHERE {RISK.format('taxable_income / 1000000')} = 'HIGH' GROUP BY customer_id""",
    "newest_partitions_scan": f"SELECT application_id, dt FROM clean WHERE dt >= {NEWEST_DAYS}",
    "lake_newest_partitions": f"SELECT dt, count(*) AS n FROM clean WHERE dt >= {NEWEST_DAYS} GROUP BY dt",
    "lake_inventory": "SELECT DISTINCT dt, true AS has_files FROM clean",
    "lake_recent_arrivals": "SELECT province, is_fraud, count(*) AS n FROM ml GROUP BY 1, 2",
    "ml_dataset": "SELECT * FROM ml",
    "recent_events": """
        SELECT ml.*, produced_at AS flink_processed_at FROM ml JOIN clean USING (application_id)
        ORDER BY produced_at DESC, application_id LIMIT 50""",
    "keep_last_per_application": """
        SELECT customer_id AS application_id, arrival, produced_at, taxable_income FROM (
          SELECT *, application_id AS arrival, row_number() OVER (PARTITION BY customer_id ORDER BY produced_at DESC, application_id DESC) AS r
          FROM clean) WHERE r = 1""",
    "readiness_report": """
        SELECT table_name, n_rows, CASE WHEN n_rows > 0 THEN 'PASS' ELSE 'WARN' END AS status FROM (
          SELECT 'enriched_tax_applications' AS table_name, count(*) AS n_rows FROM filings
          UNION ALL SELECT 'tax_kpi_windows', count(*) FROM kpis
          UNION ALL SELECT 'fraud_detections', count(*) FROM detections
          UNION ALL SELECT 'audit_log', count(*) FROM audit)""",
    "block_rate": """
        SELECT event_id // 50 AS block, count(*) AS n, count(*) FILTER (WHERE value > 150 OR event_id % 100 = 0) AS fraud_count
        FROM events WHERE event_type <> 'view' GROUP BY 1""",
    "topic_volume": """
        SELECT 'tax-applications' AS topic, count(*) AS messages FROM filings UNION ALL SELECT 'taxpayer-profiles', count(*) FROM profiles
        UNION ALL SELECT 'fraud-signals', count(*) FROM signals UNION ALL SELECT 'audit-events', count(*) FROM audit_events""",
    "archetype_tags": f"""
        SELECT * FROM (
          SELECT application_id, CASE WHEN employment_type = 'UNEMPLOYED' AND taxable_income >= 150000 THEN 'phantom_income'
                 WHEN filing_status = 'AMENDED' AND taxable_income >= 2.5 * {CEILING} THEN 'income_inflation'
                 WHEN filing_status = 'AMENDED' AND taxable_income >= 1.5 * {CEILING} AND n >= 3 THEN 'serial_filer' END AS archetype
          FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS n FROM clean)) WHERE archetype IS NOT NULL""",
    "risk_bands": f"SELECT application_id, {RISK.format('least(taxable_income / 1000000, 1.0)')} AS risk FROM clean",
    "question_routing": f"""
        SELECT question_id, intent, CASE WHEN intent = 'fraud_check' AND id <> '' THEN id END AS application_id FROM (
          SELECT question_id, {ROUTED} AS intent, upper(regexp_extract(text, '(?i)(APP-[A-Z0-9\\-]+)', 1)) AS id FROM (
            SELECT concat('c-', conv_id, '-', turn) AS question_id, text FROM conversations
            UNION ALL SELECT event_id, concat('What happened after ', action, ' to ', lower(coalesce(application_id, 'it')), '?') FROM audit_events))""",
    "audit_ingest": "SELECT event_id, application_id, actor, action, event_timestamp, metadata IS NOT NULL AS has_metadata FROM audit",
    "audit_actor_counts": f"SELECT {ACTOR} AS actor_type, action, count(*) AS n FROM audit GROUP BY 1, 2",
    "audit_metadata": f"SELECT event_id, action, {METADATA}, {REFUND} AS refund_amount FROM audit",
    "features_fit": f"""
        SELECT {FEATURES} FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS filings FROM ml)""",
    "features_score": f"""
        SELECT {FEATURES} FROM (
          SELECT c.*, count(*) FILTER (WHERE dt <= '2024-01-20') OVER (PARTITION BY customer_id)
                 + CASE WHEN dt <= '2024-01-20' THEN 0 ELSE 1 END AS filings
          FROM (SELECT ml.*, dt FROM ml JOIN clean USING (application_id)) c)""",
    "class_weights": """
        SELECT CAST(is_fraud AS INT) AS label, count(*) AS n_class,
               CAST((SELECT count(*) FROM ml) AS DOUBLE) / (2.0 * count(*)) AS weight FROM ml GROUP BY 1""",
    "stratified_split_sizes": """
        SELECT label, is_test, CASE WHEN is_test THEN k ELSE n - k END AS n FROM (
          SELECT CAST(is_fraud AS INT) AS label, count(*) AS n, CAST(floor(count(*) * 0.2 + 0.5) AS BIGINT) AS k FROM ml GROUP BY 1),
          (SELECT unnest([true, false]) AS is_test)""",
    "stratified_fold_sizes": """
        SELECT label, fold, count(*) AS n FROM (
          SELECT CAST(is_fraud AS INT) AS label, CAST(row_number() OVER (PARTITION BY is_fraud ORDER BY application_id) % 5 AS INT) AS fold FROM ml)
        GROUP BY 1, 2""",
    "pr_curve": "SELECT threshold, flagged, tp, precision, recall, f1 FROM rated",
    "pick_threshold": f"""
        SELECT objective, x.t AS threshold, x.p AS precision, x.r AS recall, x.f AS f1, feasible FROM (
          {pick('f1', 'true', 'f1')} UNION ALL {pick('recall', 'precision >= 0.6', 'recall')}
          UNION ALL {pick('precision', 'recall >= 0.3', 'precision')} UNION ALL {pick('infeasible', 'precision >= 1.01', 'recall')})""",
    "metrics_at": f"""
        SELECT {div0('tp + tn', 'tp + fp + fn + tn')} AS accuracy, {div0('tp', 'tp + fp')} AS precision, {div0('tp', 'tp + fn')} AS recall,
               {div0('2 * tp', '2 * tp + fp + fn')} AS f1_score, CAST(0.25 AS DOUBLE) AS threshold FROM cells""".replace("CAST(tp + tn AS", "CAST((tp + tn) AS"),
    "average_precision": "SELECT round(sum(CAST(pos AS DOUBLE) / positives * precision), 6) AS average_precision FROM rated",
    "confusion": """
        SELECT 1 AS label, 1 AS predicted, tp AS n FROM cells UNION ALL SELECT 0, 1, fp FROM cells
        UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 0, 0, tn FROM cells""",
    "live_scoring_counts": "SELECT tp, fp, fn, tn, tp + fp AS flagged FROM cells",
    "class_report": f"""
        SELECT 1 AS label, {div0('tp', 'tp + fp')} AS precision, {div0('tp', 'tp + fn')} AS recall, tp + fn AS support,
               {div0('2 * tp', '2 * tp + fp + fn')} AS f1 FROM cells
        UNION ALL SELECT 0, {div0('tn', 'tn + fn')}, {div0('tn', 'tn + fp')}, tn + fp, {div0('2 * tn', '2 * tn + fp + fn')} FROM cells""",
    "trial_ranking": """
        SELECT CAST(row_number() OVER (ORDER BY score DESC NULLS LAST, cv_f1 DESC NULLS LAST, family, label) AS INT) AS rank, family, label FROM trials""",
    "best_per_family": """
        SELECT family, label, score, cv_f1 FROM (
          SELECT *, row_number() OVER (PARTITION BY family ORDER BY score DESC, cv_f1 DESC, label) AS r FROM trials WHERE score IS NOT NULL)
        WHERE r = 1""",
    "top_trials": """
        SELECT family, label, score, cv_f1 FROM trials WHERE score IS NOT NULL ORDER BY score DESC, cv_f1 DESC, family, label LIMIT 12""",
    "run_pivot": f"""
        SELECT dt AS run_id, CAST({half_up(FRAUDS + ' * 10000', 'count(*)')} AS DOUBLE) / 10000 AS fraud_share,
               CAST({half_up("count(*) FILTER (WHERE filing_status = 'AMENDED') * 10000", 'count(*)')} AS DOUBLE) / 10000 AS amended_share,
               CAST(count(*) AS DOUBLE) AS n FROM clean GROUP BY dt""",
    "point_ids": f"SELECT application_id, {uuid5('application_id')} AS point_id FROM filings",
    "new_records_anti": "SELECT application_id, dt FROM clean WHERE dt > '2024-01-20'",
    "record_text": """
        SELECT application_id, concat('Province ', province, ' income ', CAST(taxable_income AS VARCHAR), ' employment ', employment_type,
               ' status ', employment_status, ' filing ', filing_status, ' fraud ', CASE WHEN is_fraud THEN 'True' ELSE 'False' END) AS text FROM ml""",
    "payload": """
        SELECT application_id, customer_id, taxable_income, employment_type, employment_status, filing_status,
               coalesce(province, 'UNKNOWN') AS province, CAST(0 AS DOUBLE) AS risk_score, is_fraud, produced_at AS processed_at FROM clean""",
    "knn_cosine": "SELECT label, vec_id, CAST(rank AS INT) AS rank, round(similarity, 4) AS similarity FROM alike",
    "similar_case_evidence": """
        SELECT *, CASE WHEN similar_fraud >= 3 THEN 'ELEVATED' ELSE 'UNAVAILABLE' END AS risk FROM (
          SELECT label, count(*) AS n_cases, count(*) FILTER (WHERE is_fraud AND round(similarity, 4) > 0.5) AS similar_fraud,
                 round(max(similarity), 4) AS best_similarity,
                 string_agg(CAST(vec_id AS VARCHAR), ', ' ORDER BY rank) FILTER (WHERE rank <= 3) AS shown_cases
          FROM alike GROUP BY label)""",
    "md_chunks": f"""
        SELECT file, CAST(position AS INT) AS position, section, {line('body', 'Source')} AS source, {line('body', 'Status')} AS status, authority,
               concat(section, chr(10), body) AS text FROM parts""",
    "chunk_points": f"""
        SELECT file, CAST(position AS INT) AS position, concat(file, '::', section) AS chunk_id, {uuid5("concat(file, '::', section)")} AS point_id FROM parts""",
    "kb_context": f"""
        SELECT question_id, string_agg(block, concat(chr(10), chr(10)) ORDER BY rank) AS context FROM (
          SELECT question_id, rank, {HEADER} AS block FROM ({kb_hits('knowledge', 4)}) JOIN knowledge USING (chunk)) GROUP BY question_id""",
    "kb_fallback": f"""
        SELECT question_id, chunk, CAST(rank AS INT) AS rank, collection, round(similarity, 4) AS similarity FROM (
          SELECT *, 'first' AS collection FROM ({kb_hits('(SELECT * FROM knowledge WHERE length(text) >= 200)', 4)}) WHERE similarity >= 0.95
          UNION ALL
          SELECT *, 'second' AS collection FROM ({kb_hits('(SELECT * FROM knowledge WHERE length(text) < 200)', 3)}) WHERE similarity >= 0.95
            AND question_id NOT IN (SELECT question_id FROM ({kb_hits('(SELECT * FROM knowledge WHERE length(text) >= 200)', 4)}) WHERE similarity >= 0.95))""",
    "lineage_jobs": f"""
        SELECT namespace, job_name, concat(input_a, ', ', input_b) AS inputs, output_a AS outputs, event_time AS updated_at
        FROM (SELECT *, {LAST_RUN} AS r FROM run_events) WHERE r = 1""",
    "lineage_datasets": "SELECT * FROM sets",
    "lineage_latest_state": f"""
        SELECT e.namespace, e.job_name, coalesce({STATE.replace('ELSE', "WHEN 'FAIL' THEN")}, 'NO_RUN') AS state
        FROM expected_jobs e LEFT JOIN (SELECT * FROM (SELECT *, {LAST_RUN} AS r FROM run_events) WHERE r = 1) s
          ON e.namespace = s.namespace AND e.job_name = s.job_name""",
    "lineage_missing": """
        SELECT namespace, job_name FROM expected_jobs EXCEPT SELECT namespace, job_name FROM run_events""",
    "lineage_totals": """
        SELECT namespace, coalesce(jobs, 0) AS jobs, coalesce(datasets, 0) AS datasets FROM
          (SELECT namespace, count(DISTINCT job_name) AS jobs FROM run_events GROUP BY 1)
          FULL JOIN (SELECT namespace, count(*) AS datasets FROM sets GROUP BY 1) USING (namespace)""",
    "stream_kpi": windows("timed", 300),
    "stream_fraud_patterns": """
        SELECT * FROM high_frequency
        UNION ALL SELECT * FROM spikes""",
    "stream_enrich": f"""
        SELECT a.application_id, a.customer_id, coalesce(p.age, 0) AS age,
               CAST(CAST(coalesce(p.risk_score, 0) AS DECIMAL(5,4)) AS DOUBLE) AS risk_score, coalesce(p.avg_income_3yr, 0) AS avg_income_3yr
        FROM typed a LEFT JOIN known p ON {HOUR}""",
    "busiest_province": f"""
        SELECT w AS window_start, province AS busiest_province FROM (
          SELECT w, province, row_number() OVER (PARTITION BY w ORDER BY count(*) DESC, province) AS r
          FROM (SELECT *, {bucket('event_time', 86400)} AS w FROM clean) WHERE province IS NOT NULL GROUP BY w, province) WHERE r = 1""",
    "first_arrivals": "SELECT DISTINCT customer_id AS application_id FROM clean",
    "stream_kpi_early": f"SELECT * EXCLUDE (distinct_customers) FROM ({windows('timed', 300)})",
    "stream_clean": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "stream_raw_archive": "SELECT substring(submitted_date, 1, 10) AS dt, count(*) AS n, count(customer_id) AS with_customer FROM filings GROUP BY 1",
    "stream_detections": normal_form("signals"),
    "stream_audit": f"""
        SELECT action, channel, trigger_reason, validation_rule, count(*) AS n, sum(refund_amount) AS refunds
        FROM (SELECT event_id, action, {METADATA}, {REFUND} AS refund_amount FROM audit) GROUP BY 1, 2, 3, 4""",
    "stream_vector_sync": f"""
        SELECT application_id, {uuid5('application_id')} AS point_id, customer_id, taxable_income, employment_type, employment_status, filing_status,
               coalesce(province, 'UNKNOWN') AS province, CAST(0 AS DOUBLE) AS risk_score, is_fraud, '2024-02-01 00:00:00' AS processed_at FROM clean""",
    "stream_kpi_cache": CACHE.replace(" AS top_province\n", " AS top_province, window_end + INTERVAL 2 DAYS AS expires_at\n").replace(
        "(SELECT * FROM cache_input ORDER BY window_start DESC LIMIT 20)",
        "raw_cache WHERE window_end + INTERVAL 2 DAYS > (SELECT max(window_end) FROM raw_cache)"),
}
STATEMENTS["stream_enrich_once"] = STATEMENTS["enrich_one_per_application"]
STATEMENTS["stream_asof"] = STATEMENTS["asof_profile"]
BASE["raw_cache"] = BASE["cache_input"].replace("FROM clean", "FROM timed")

ORACLES = {name: with_tables(sql) for name, sql in STATEMENTS.items()}
