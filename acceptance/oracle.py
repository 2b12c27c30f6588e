"""Query name -> SQL for DuckDB over the driver tables, written apart from the Spark plans.

Building blocks are common table expressions; a query pulls in those it mentions.
"""

from __future__ import annotations

import re

_COMPANY = "CAST(o_custkey AS VARCHAR)"
_ORDER_AMOUNT = """CASE WHEN o_orderkey % 101 = 0 THEN NULL
        WHEN o_orderkey % 103 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
        ELSE CAST(o_totalprice AS DECIMAL(18,2)) END"""
_LINE_ID = """CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
        CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-' ||
        strftime(l_shipdate, '%Y%m%d') || '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)"""
# Whole cents over 12, half up; amounts here are never negative.
_MRR = """CAST(CAST(((CAST(round(amount_usd * 100) AS BIGINT) * 2 + 12) // 24) AS DECIMAL(18,0)) / 100
        AS DECIMAL(18,2))"""

_BLOCKS = {
    "stg_companies": """
        SELECT CAST(c_custkey AS VARCHAR) AS company_id,
               CASE WHEN c_custkey % 50 = 0 THEN '  ' || c_name || '  '
                    WHEN c_custkey % 211 = 5 THEN 'HubSpot' ELSE c_name END AS name,
               'c' || CAST(c_custkey AS VARCHAR) || '.com' AS domain,
               CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS industry,
               CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(c_custkey % 5000 + 1 AS BIGINT) END
                   AS employee_count,
               CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(round(c_acctbal) AS BIGINT) END
                   AS annual_revenue_usd,
               CAST(NULL AS VARCHAR) AS city,
               n_name AS country,
               TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at_hubspot,
               TIMESTAMP '1995-01-11' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS modified_at_hubspot,
               TIMESTAMP '2024-01-31 06:00:00' AS _loaded_at
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "stg_deals": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS deal_id,
               'Deal ' || CAST(o_orderkey AS VARCHAR) AS deal_name,
               {_ORDER_AMOUNT} AS amount_usd,
               CASE WHEN o_orderstatus = 'F' THEN 'closedwon'
                    WHEN o_orderstatus = 'P' THEN 'closedlost'
                    WHEN o_orderpriority LIKE '1%' THEN 'contractsent'
                    WHEN o_orderpriority LIKE '2%' THEN 'decisionmakerboughtin'
                    WHEN o_orderpriority LIKE '3%' THEN 'presentationscheduled'
                    WHEN o_orderpriority LIKE '4%' THEN 'qualifiedtobuy'
                    WHEN o_orderpriority LIKE '5%' THEN 'appointmentscheduled' END AS stage_id,
               CASE WHEN o_orderkey % 10 < 7 THEN 'newbusiness' ELSE 'existingbusiness' END AS deal_type,
               'default' AS pipeline_id,
               CAST(o_orderdate AS TIMESTAMP) AS close_date,
               o_orderdate - INTERVAL 30 DAY AS created_at_hubspot,
               CAST(o_orderdate AS TIMESTAMP) AS modified_at_hubspot,
               o_orderdate + INTERVAL 30 HOUR AS _loaded_at
        FROM orders""",
    "stg_subscriptions": f"""
        SELECT 'sub_' || CAST(o_orderkey AS VARCHAR) AS subscription_id,
               CAST(o_orderkey AS VARCHAR) AS deal_id,
               CASE WHEN o_orderkey % 10 < 3 THEN 'monthly' ELSE 'annual' END AS billing_interval,
               {_ORDER_AMOUNT} AS amount_usd,
               CAST(CASE o_orderkey % 3 WHEN 0 THEN 12 WHEN 1 THEN 24 ELSE 36 END AS INTEGER) AS term_months,
               CASE WHEN o_orderkey % 7 = 0 THEN 'churned' ELSE 'active' END AS status,
               CAST(o_orderdate AS TIMESTAMP) AS started_at,
               CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 90 DAY END AS churned_at,
               o_orderdate + INTERVAL 30 HOUR AS _loaded_at
        FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 101 <> 0""",
    "stg_line_items": f"""
        SELECT {_LINE_ID} AS line_item_id,
               'Part ' || CAST(l_partkey AS VARCHAR) AS product_name,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                    // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))
                    AS unit_price_usd,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount_usd,
               CAST(l_partkey AS VARCHAR) AS product_id,
               CAST(l_shipdate AS TIMESTAMP) AS created_at_hubspot,
               CAST(l_shipdate AS TIMESTAMP) AS modified_at_hubspot,
               l_shipdate + INTERVAL 30 HOUR AS _loaded_at
        FROM lineitem""",
    "stg_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
               p_name AS product_name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price_usd,
               p_brand || '-' || CAST(p_partkey AS VARCHAR) AS sku,
               TIMESTAMP '1995-01-01' AS created_at_hubspot,
               TIMESTAMP '1995-01-01' AS modified_at_hubspot,
               TIMESTAMP '2024-01-31 06:00:00' AS _loaded_at
        FROM part""",
    "touches": """
        SELECT user_id * 20 + event_id % 20 AS id, CAST(ts AS TIMESTAMP) AS ts,
               CASE event_type WHEN 'view' THEN 'lead' WHEN 'click' THEN 'marketingqualifiedlead'
                    WHEN 'signup' THEN 'salesqualifiedlead' WHEN 'error' THEN 'opportunity'
                    WHEN 'purchase' THEN 'customer' END AS stage,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                    WHEN 'error' THEN 4 WHEN 'purchase' THEN 5 END AS ordinal
        FROM events""",
    "people": "SELECT id, min(ts) AS ts, max(ordinal) AS ordinal FROM touches GROUP BY id",
    "stg_contacts": """
        SELECT CAST(id AS VARCHAR) AS contact_id,
               'F' || CAST((id + CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END) % 1000 AS VARCHAR) AS first_name,
               'L' || CAST((id + CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END) // 1000 AS VARCHAR) AS last_name,
               CASE WHEN id % 31 = 0 THEN NULL WHEN id % 37 = 0 THEN 'test@test.com'
                    WHEN id % 5 = 0 THEN ' C' || CAST(id AS VARCHAR) || '@X.COM '
                    ELSE 'c' || CAST(id AS VARCHAR) || '@x.com' END AS email,
               'Title ' || CAST(id % 7 AS VARCHAR) AS job_title,
               CAST(NULL AS VARCHAR) AS phone,
               CASE ordinal WHEN 1 THEN 'lead' WHEN 2 THEN 'marketingqualifiedlead'
                    WHEN 3 THEN 'salesqualifiedlead' WHEN 4 THEN 'opportunity' WHEN 5 THEN 'customer' END
                    AS lifecycle_stage,
               ts AS created_at_hubspot, ts AS modified_at_hubspot,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 30 HOUR AS _loaded_at
        FROM people""",
    "stg_lifecycle": """
        SELECT CAST(id AS VARCHAR) || '_' || stage AS event_id, CAST(id AS VARCHAR) AS contact_id,
               stage AS lifecycle_stage, min(ts) AS entered_at,
               CAST(date_trunc('day', min(ts)) AS TIMESTAMP) + INTERVAL 30 HOUR AS _loaded_at
        FROM touches GROUP BY id, stage""",
    "links_contact_company": """
        SELECT CAST(id AS VARCHAR) AS contact_id, CAST(id % (SELECT count(*) FROM customer) AS VARCHAR) AS company_id,
               'contact_to_company' AS link_type,
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 30 HOUR AS _loaded_at
        FROM people WHERE id % 41 <> 0
        UNION ALL
        SELECT CAST(id AS VARCHAR), CAST((id + 1) % (SELECT count(*) FROM customer) AS VARCHAR),
               'contact_to_company_unlabeled',
               CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 30 HOUR
        FROM people WHERE id % 41 <> 0 AND id % 3 = 0""",
    "links_deal_company": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, {_COMPANY} AS company_id,
               CASE WHEN o_orderkey % 4 = 0 THEN 'deal_to_company_unlabeled' ELSE 'deal_to_company' END
                   AS link_type,
               o_orderdate + INTERVAL 30 HOUR AS _loaded_at
        FROM orders""",
    "links_line_item_deal": f"""
        SELECT {_LINE_ID} AS line_item_id, CAST(l_orderkey AS VARCHAR) AS deal_id,
               'line_item_to_deal' AS link_type, l_shipdate + INTERVAL 30 HOUR AS _loaded_at
        FROM lineitem""",
    "int_companies": """
        SELECT company_id, trim(name) AS name, domain, industry, employee_count, annual_revenue_usd, city,
               country, created_at_hubspot, modified_at_hubspot, _loaded_at
        FROM stg_companies
        WHERE trim(name) <> 'HubSpot'
          AND NOT (industry IS NULL AND employee_count IS NULL AND annual_revenue_usd IS NULL)""",
    "int_contacts": """
        SELECT contact_id, company_id, first_name, last_name, email, job_title, phone, lifecycle_stage,
               created_at_hubspot, modified_at_hubspot, _loaded_at
        FROM (
            SELECT s.contact_id, l.company_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
                   lower(trim(email)) AS email, job_title, phone, lifecycle_stage, created_at_hubspot,
                   modified_at_hubspot, s._loaded_at,
                   row_number() OVER (PARTITION BY trim(first_name), trim(last_name)
                                      ORDER BY created_at_hubspot NULLS LAST, s.contact_id, l.company_id) AS rn
            FROM stg_contacts s
            LEFT JOIN (SELECT * FROM links_contact_company WHERE link_type = 'contact_to_company') l
                   ON s.contact_id = l.contact_id
            WHERE lower(trim(email)) NOT IN ('test@test.com', 'qa-bot@example.com', 'delete-me@nowhere.com',
                                             'emailmaria@hubspot.com', 'bh@hubspot.com')
        ) WHERE rn = 1""",
    "int_deals": """
        SELECT deal_id, deal_name, amount_usd, stage_id, deal_type, pipeline_id, close_date,
               COALESCE(stage_id NOT IN ('closedwon', 'closedlost')
                        AND close_date < TIMESTAMP '2000-01-01', false) AS is_stale,
               created_at_hubspot, modified_at_hubspot, _loaded_at
        FROM stg_deals WHERE amount_usd >= 0""",
    "int_lifecycle": """
        SELECT event_id, contact_id, lifecycle_stage,
               CAST(CASE lifecycle_stage WHEN 'lead' THEN 1 WHEN 'marketingqualifiedlead' THEN 2
                    WHEN 'salesqualifiedlead' THEN 3 WHEN 'opportunity' THEN 4 WHEN 'customer' THEN 5 END
                    AS INTEGER) AS stage_order,
               entered_at, _loaded_at
        FROM stg_lifecycle WHERE contact_id IN (SELECT contact_id FROM int_contacts)""",
    "int_deal_company_primary": """
        SELECT deal_id, company_id, _loaded_at FROM (
            SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY
                       CASE WHEN link_type = 'deal_to_company' THEN 0 ELSE 1 END, company_id) AS rn
            FROM links_deal_company) WHERE rn = 1""",
    "int_contact_company_primary": """
        SELECT contact_id, company_id, _loaded_at FROM links_contact_company
        WHERE link_type = 'contact_to_company'""",
    "int_line_item_deal_primary": """
        SELECT line_item_id, deal_id, _loaded_at FROM links_line_item_deal
        WHERE link_type = 'line_item_to_deal'""",
    "int_subscriptions": """
        SELECT subscription_id, deal_id, billing_interval, amount_usd, term_months, status,
               status = 'active' AS is_active, status = 'churned' AS is_churned, started_at, churned_at,
               _loaded_at
        FROM stg_subscriptions""",
    "int_line_items": "SELECT * FROM stg_line_items",
    "int_products": "SELECT * FROM stg_products",
    "dim_accounts": """
        SELECT c.company_id, c.name, c.domain, c.industry, c.employee_count, c.annual_revenue_usd, c.city,
               c.country, CAST(COALESCE(k.n, 0) AS BIGINT) AS contact_count,
               CAST(COALESCE(d.n, 0) AS BIGINT) AS deal_count_total,
               CAST(COALESCE(d.won, 0) AS BIGINT) AS deal_count_won,
               CAST(COALESCE(d.lost, 0) AS BIGINT) AS deal_count_lost,
               CAST(COALESCE(d.open, 0) AS BIGINT) AS deal_count_open,
               c.created_at_hubspot, CAST(c.created_at_hubspot AS DATE) AS created_date
        FROM int_companies c
        LEFT JOIN (SELECT company_id, count(*) AS n,
                          count(*) FILTER (stage_id = 'closedwon') AS won,
                          count(*) FILTER (stage_id = 'closedlost') AS lost,
                          count(*) FILTER (stage_id NOT IN ('closedwon', 'closedlost')) AS open
                   FROM int_deals JOIN int_deal_company_primary USING (deal_id)
                   GROUP BY company_id) d ON c.company_id = d.company_id
        LEFT JOIN (SELECT company_id, count(*) AS n FROM int_contact_company_primary GROUP BY company_id) k
               ON c.company_id = k.company_id""",
    "dim_contacts": """
        SELECT c.contact_id, c.first_name, c.last_name, c.first_name || ' ' || c.last_name AS full_name,
               c.email, c.job_title, c.phone, c.lifecycle_stage, c.company_id, co.name AS company_name,
               c.created_at_hubspot, CAST(c.created_at_hubspot AS DATE) AS created_date
        FROM int_contacts c LEFT JOIN int_companies co ON c.company_id = co.company_id""",
    "fct_deals": """
        SELECT d.deal_id, l.company_id, co.name AS company_name, d.deal_name, d.amount_usd, d.deal_type,
               d.stage_id, d.pipeline_id, d.close_date, CAST(d.close_date AS DATE) AS close_date_day,
               d.stage_id = 'closedwon' AS is_won, d.stage_id = 'closedlost' AS is_lost,
               d.stage_id IN ('closedwon', 'closedlost') AS is_closed,
               d.stage_id NOT IN ('closedwon', 'closedlost') AS is_open, d.is_stale,
               d.created_at_hubspot, CAST(d.created_at_hubspot AS DATE) AS created_date
        FROM int_deals d
        LEFT JOIN int_deal_company_primary l ON d.deal_id = l.deal_id
        LEFT JOIN int_companies co ON l.company_id = co.company_id""",
    "fct_pipeline": """
        SELECT m.stage_id, m.stage_label, CAST(m.display_order AS INTEGER) AS display_order,
               CAST(m.win_probability AS DECIMAL(2,1)) AS win_probability,
               CAST(COALESCE(a.n, 0) AS BIGINT) AS open_deal_count,
               CAST(COALESCE(a.total, 0) AS DECIMAL(38,2)) AS total_open_value_usd,
               COALESCE(round(CAST(a.total AS DOUBLE) / a.n, 4), 0.0) AS avg_deal_value_usd,
               CAST(COALESCE(CAST(a.total AS DECIMAL(34,2)) * CAST(m.win_probability AS DECIMAL(2,1)), 0)
                    AS DECIMAL(38,3)) AS weighted_value_usd
        FROM (VALUES ('appointmentscheduled', 'Appointment Scheduled', 1, 0.2),
                     ('qualifiedtobuy', 'Qualified To Buy', 2, 0.4),
                     ('presentationscheduled', 'Presentation Scheduled', 3, 0.6),
                     ('decisionmakerboughtin', 'Decision Maker Bought-In', 4, 0.8),
                     ('contractsent', 'Contract Sent', 5, 0.9))
             AS m(stage_id, stage_label, display_order, win_probability)
        LEFT JOIN (SELECT stage_id, count(*) AS n, sum(amount_usd) AS total FROM fct_deals
                   WHERE is_open GROUP BY stage_id) a ON m.stage_id = a.stage_id""",
    "fct_revenue": f"""
        SELECT s.subscription_id, s.deal_id, d.company_id, d.company_name, d.deal_name, d.deal_type,
               d.close_date, CAST(date_trunc('month', d.close_date) AS DATE) AS metric_month,
               s.billing_interval, s.term_months, s.status, s.is_churned, s.churned_at,
               s.amount_usd AS acv_usd, s.mrr_usd, s.amount_usd AS arr_usd,
               CAST(s.amount_usd * (s.term_months // 12) AS DECIMAL(18,2)) AS tcv_usd,
               CAST(CASE WHEN s.is_churned THEN s.mrr_usd ELSE 0 END AS DECIMAL(18,2)) AS churned_mrr_usd,
               s._loaded_at
        FROM (SELECT *, {_MRR} AS mrr_usd FROM int_subscriptions) s
        JOIN fct_deals d ON s.deal_id = d.deal_id WHERE d.is_won""",
    "fct_funnel": """
        SELECT e.event_id, e.contact_id, c.company_id, c.company_name, e.lifecycle_stage, e.stage_order,
               e.previous_stage, e.entered_at, CAST(e.entered_at AS DATE) AS entered_date,
               e.previous_entered_at,
               CAST(date_diff('day', CAST(e.previous_entered_at AS DATE), CAST(e.entered_at AS DATE)) AS INTEGER)
                   AS days_to_convert,
               k.cohort_month
        FROM (SELECT *, lag(lifecycle_stage) OVER w AS previous_stage, lag(entered_at) OVER w AS previous_entered_at
              FROM int_lifecycle WINDOW w AS (PARTITION BY contact_id ORDER BY stage_order)) e
        LEFT JOIN (SELECT contact_id, CAST(date_trunc('month', min(entered_at)) AS DATE) AS cohort_month
                   FROM int_lifecycle GROUP BY contact_id) k ON e.contact_id = k.contact_id
        LEFT JOIN dim_contacts c ON e.contact_id = c.contact_id""",
    "fct_account_health": """
        SELECT company_id, name AS company_name, industry,
               CASE max_stage WHEN 1 THEN 'lead' WHEN 2 THEN 'marketingqualifiedlead'
                    WHEN 3 THEN 'salesqualifiedlead' WHEN 4 THEN 'opportunity' WHEN 5 THEN 'customer' END
                    AS lifecycle_stage,
               contact_count, deal_count_total, deal_count_won, deal_count_lost, deal_count_open,
               round(ratio, 3) AS win_rate,
               CAST(arr AS DECIMAL(38,2)) AS arr_usd, CAST(open_value AS DECIMAL(38,2)) AS open_pipeline_usd,
               churn AS has_churn, last_activity_date,
               CAST(round(greatest(0.0, least(100.0,
                    (CASE WHEN arr > 0 THEN 40 ELSE 0 END) + ratio * 20
                    + (CASE WHEN open_value > 0 THEN 20 ELSE 0 END)
                    + (CASE WHEN last_activity_date >= DATE '2000-01-01' - 90 THEN 20
                            WHEN last_activity_date >= DATE '2000-01-01' - 180 THEN 10 ELSE 0 END)
                    - (CASE WHEN churn THEN 20 ELSE 0 END)))) AS INTEGER) AS account_health_score
        FROM (
            SELECT a.*, f.max_stage, d.last_activity_date,
                   COALESCE(CAST(a.deal_count_won AS DOUBLE)
                            / CAST(nullif(a.deal_count_won + a.deal_count_lost, 0) AS DOUBLE), 0.0) AS ratio,
                   COALESCE(r.arr, 0) AS arr, COALESCE(d.open_value, 0) AS open_value,
                   COALESCE(r.churn, false) AS churn
            FROM dim_accounts a
            LEFT JOIN (SELECT company_id, sum(CASE WHEN NOT is_churned THEN arr_usd ELSE 0 END) AS arr,
                              bool_or(is_churned) AS churn FROM fct_revenue GROUP BY company_id) r
                   ON a.company_id = r.company_id
            LEFT JOIN (SELECT company_id, sum(CASE WHEN is_open THEN amount_usd ELSE 0 END) AS open_value,
                              max(created_date) AS last_activity_date FROM fct_deals GROUP BY company_id) d
                   ON a.company_id = d.company_id
            LEFT JOIN (SELECT company_id, max(stage_order) AS max_stage FROM fct_funnel GROUP BY company_id) f
                   ON a.company_id = f.company_id)""",
    "health_scored": """
        SELECT *, CASE WHEN account_health_score >= 70 THEN 'healthy'
                       WHEN account_health_score >= 40 THEN 'moderate' ELSE 'at-risk' END AS health_bucket
        FROM fct_account_health""",
    "funnel_by_stage": """
        SELECT lifecycle_stage, count(DISTINCT contact_id) AS contact_count, min(stage_order) AS stage_order,
               CASE lifecycle_stage WHEN 'lead' THEN 'Lead' WHEN 'marketingqualifiedlead' THEN 'MQL'
                    WHEN 'salesqualifiedlead' THEN 'SQL' WHEN 'opportunity' THEN 'Opportunity (SQO)'
                    WHEN 'customer' THEN 'Customer' ELSE lifecycle_stage END AS label
        FROM fct_funnel GROUP BY lifecycle_stage""",
    "payloads": """
        SELECT company_id, '{"id":"' || company_id || '","properties":{"arr_usd":"' || CAST(arr_usd AS VARCHAR)
               || '","open_pipeline_usd":"' || CAST(open_pipeline_usd AS VARCHAR)
               || '","account_health_score":"' || CAST(account_health_score AS VARCHAR)
               || '","last_synced_from_warehouse":' || CAST(epoch_ms(TIMESTAMP '2024-02-01 12:00:00') AS VARCHAR)
               || '}}' AS payload
        FROM fct_account_health""",
}


def _query(final: str) -> str:
    """``final`` behind the blocks it needs, in definition order."""
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in _BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(_BLOCKS[name])
    blocks = [f"{name} AS ({sql})" for name, sql in _BLOCKS.items() if name in needed]
    return (f"WITH {', '.join(blocks)} " if blocks else "") + final


def _cuts(value: str, source: str, *cuts: str) -> str:
    if not cuts:
        return f"SELECT 'all' AS cut, CAST(NULL AS VARCHAR) AS cut_value, {value} AS value FROM {source}"
    parts = [_cuts(value, source)]
    parts += [
        f"SELECT '{c}', CAST({c} AS VARCHAR), {value} FROM {source} GROUP BY {c}" for c in cuts
    ]
    return " UNION ALL ".join(parts)


def _money(expression: str) -> str:
    return f"CAST(sum({expression}) AS DECIMAL(38,2))"


def _conversion(source: str, target: str) -> str:
    def reached(stage: str) -> str:
        return f"CAST(count(DISTINCT contact_id) FILTER (lifecycle_stage = '{stage}') AS DOUBLE)"

    return f"round({reached(target)} / nullif({reached(source)}, 0), 6)"


def _histogram(value: str, source: str, low: str, high: str) -> str:
    return f"""
        SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + (hi - lo) / 20.0 * (b.bin - 1), 4) AS bin_low,
               round(lo + (hi - lo) / 20.0 * b.bin, 4) AS bin_high, CAST(COALESCE(c.n, 0) AS BIGINT) AS row_count
        FROM (SELECT CAST(unnest(range(1, 21)) AS DOUBLE) AS bin) b
        CROSS JOIN (SELECT CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi FROM {source}) r
        LEFT JOIN (
            SELECT least(20, floor(20.0 * (CAST({value} AS DOUBLE) - lo) / (hi - lo)) + 1) AS bin, count(*) AS n
            FROM {source} CROSS JOIN (SELECT CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi FROM {source})
            GROUP BY 1) c ON c.bin = b.bin"""


_LIVE_MRR = "CASE WHEN is_churned THEN 0 ELSE mrr_usd END"
_LIVE_ARR = "CASE WHEN is_churned THEN 0 ELSE arr_usd END"
_HANDOFFS = (
    "(SELECT * FROM fct_funnel WHERE lifecycle_stage = 'salesqualifiedlead' AND days_to_convert IS NOT NULL)"
)


def _metric_sql() -> dict[str, str]:
    revenue = "fct_revenue"
    return {
        "metric_mrr": _cuts(_money("mrr_usd"), revenue, "metric_month", "company_id", "is_churned"),
        "metric_arr": _cuts(_money("arr_usd"), revenue, "is_churned"),
        "metric_arr_active": _cuts(_money(_LIVE_ARR), revenue, "metric_month"),
        "metric_acv": _cuts("round(CAST(sum(acv_usd) AS DOUBLE) / count(acv_usd), 6)", revenue, "deal_type"),
        "metric_acv_total": _cuts(_money("acv_usd"), revenue, "deal_type"),
        "metric_tcv": _cuts(_money("tcv_usd"), revenue, "deal_type", "metric_month"),
        "metric_churned_mrr": _cuts(_money("churned_mrr_usd"), revenue, "metric_month", "company_id"),
        "metric_active_mrr": _cuts(_money(_LIVE_MRR), revenue, "metric_month"),
        "metric_open_pipeline": _cuts(_money("total_open_value_usd"), "fct_pipeline", "stage_id"),
        "metric_weighted_pipeline": _cuts(
            "CAST(sum(weighted_value_usd) AS DECIMAL(38,3))", "fct_pipeline", "stage_id"
        ),
        "metric_win_rate": _cuts(
            "round(CAST(count(*) FILTER (is_won) AS DOUBLE) / nullif(count(*) FILTER (is_closed), 0), 6)",
            "fct_deals",
            "company_id",
        ),
        "metric_lead_to_mql": _cuts(_conversion("lead", "marketingqualifiedlead"), "fct_funnel", "cohort_month"),
        "metric_mql_to_sql": _cuts(
            _conversion("marketingqualifiedlead", "salesqualifiedlead"), "fct_funnel", "cohort_month"
        ),
        "metric_sql_to_customer": _cuts(
            _conversion("salesqualifiedlead", "customer"), "fct_funnel", "cohort_month"
        ),
        "metric_median_days_mql_to_sql": _cuts(
            "CAST(median(days_to_convert) AS DOUBLE)", _HANDOFFS, "cohort_month"
        ),
        "metric_account_health": _cuts(
            "round(CAST(sum(account_health_score) AS DOUBLE) / count(account_health_score), 6)",
            "health_scored",
            "health_bucket",
        ),
        "metric_arr_per_account": _cuts(_money("arr_usd"), "fct_account_health", "company_id"),
        "metric_account_health_buckets": (
            "SELECT health_bucket, count(*) AS accounts FROM health_scored GROUP BY health_bucket"
        ),
        "cohort_conversion_within": """
            SELECT CAST(date_trunc('month', lead_at) AS DATE) AS source_month,
                   CAST(span AS INTEGER) AS within_days, count(*) AS entered,
                   count(*) FILTER (mql_at >= lead_at
                       AND date_diff('day', CAST(lead_at AS DATE), CAST(mql_at AS DATE)) <= span) AS reached,
                   round(CAST(count(*) FILTER (mql_at >= lead_at
                       AND date_diff('day', CAST(lead_at AS DATE), CAST(mql_at AS DATE)) <= span) AS DOUBLE)
                       / count(*), 6) AS rate
            FROM (SELECT contact_id, min(entered_at) FILTER (lifecycle_stage = 'lead') AS lead_at,
                         min(entered_at) FILTER (lifecycle_stage = 'marketingqualifiedlead') AS mql_at
                  FROM fct_funnel GROUP BY contact_id) t
            CROSS JOIN (VALUES (1), (7), (90)) AS s(span)
            WHERE lead_at IS NOT NULL GROUP BY 1, 2""",
    }


def _report_sql() -> dict[str, str]:
    return {
        "kpi_revenue": f"""SELECT {_money(_LIVE_MRR)} AS active_mrr, {_money(_LIVE_ARR)} AS active_arr,
            {_money("churned_mrr_usd")} AS churned_mrr, count(*) AS won_deals FROM fct_revenue""",
        "kpi_pipeline": f"""SELECT {_money("total_open_value_usd")} AS open_pipeline,
            CAST(sum(weighted_value_usd) AS DECIMAL(38,3)) AS weighted_pipeline,
            CAST(sum(open_deal_count) AS BIGINT) AS open_deals FROM fct_pipeline""",
        "kpi_win_rate": """SELECT count(*) FILTER (is_won) AS won_count, count(*) FILTER (is_closed) AS closed_count,
            round(CAST(count(*) FILTER (is_won) AS DOUBLE) / nullif(count(*) FILTER (is_closed), 0), 6) AS win_rate
            FROM fct_deals""",
        "report_mrr_by_month": f"""SELECT metric_month, {_money("mrr_usd")} AS booked_mrr FROM fct_revenue
            GROUP BY metric_month ORDER BY metric_month""",
        "report_acv_histogram": _histogram("acv_usd", "fct_revenue", "min(acv_usd)", "max(acv_usd)"),
        "report_tcv_by_type": f"""SELECT deal_type, {_money("tcv_usd")} AS total_tcv, count(*) AS deal_count
            FROM fct_revenue GROUP BY deal_type ORDER BY total_tcv DESC""",
        "report_pipeline_by_stage": """SELECT stage_id, open_deal_count, total_open_value_usd, weighted_value_usd
            FROM fct_pipeline ORDER BY weighted_value_usd DESC""",
        "report_pipeline_long": """
            SELECT stage_id, 'Raw pipeline' AS metric, CAST(total_open_value_usd AS DECIMAL(38,3)) AS usd
            FROM fct_pipeline UNION ALL
            SELECT stage_id, 'Probability-weighted', weighted_value_usd FROM fct_pipeline""",
        "report_funnel_counts": """SELECT lifecycle_stage, contact_count, stage_order, label
            FROM funnel_by_stage ORDER BY stage_order""",
        "report_funnel_steps": """SELECT from_label, label AS to_label,
            round(COALESCE(CAST(contact_count AS DOUBLE) / nullif(before, 0), 0.0), 6) AS rate
            FROM (SELECT *, lag(label) OVER (ORDER BY stage_order) AS from_label,
                         lag(contact_count) OVER (ORDER BY stage_order) AS before FROM funnel_by_stage)
            WHERE before IS NOT NULL""",
        "sketch_stage_counts": """SELECT CAST(date_trunc('quarter', cohort_month) AS DATE) AS period, lifecycle_stage,
            count(DISTINCT contact_id) AS contact_count FROM fct_funnel GROUP BY ALL""",
        "sketch_conversion": """SELECT period, source_count, target_count, both_count,
            CAST(both_count AS DOUBLE) / nullif(source_count, 0) AS rate
            FROM (SELECT period, count(*) FILTER (l) AS source_count, count(*) FILTER (m) AS target_count,
                         count(*) FILTER (l AND m) AS both_count
                  FROM (SELECT CAST(date_trunc('quarter', cohort_month) AS DATE) AS period, contact_id,
                               bool_or(lifecycle_stage = 'lead') AS l, bool_or(lifecycle_stage = 'marketingqualifiedlead') AS m
                        FROM fct_funnel GROUP BY ALL) WHERE l OR m GROUP BY period)""",
        "sketch_handoff_median": f"""SELECT CAST(date_trunc('year', cohort_month) AS DATE) AS period, count(*) AS handoffs,
            CAST(quantile_disc(days_to_convert, 0.5) AS BIGINT) AS days FROM {_HANDOFFS} GROUP BY ALL""",
        "report_median_handoff": f"SELECT CAST(median(days_to_convert) AS DOUBLE) AS median_days FROM {_HANDOFFS}",
        "report_health_list": """SELECT company_id, company_name, arr_usd, open_pipeline_usd, account_health_score,
            has_churn FROM fct_account_health ORDER BY account_health_score DESC""",
        "report_health_histogram": _histogram(
            "account_health_score", "fct_account_health", "min(0)", "min(100)"
        ),
        "top_accounts_by_arr": """SELECT company_id, company_name, arr_usd, account_health_score
            FROM fct_account_health ORDER BY arr_usd DESC, account_health_score DESC, company_id LIMIT 10""",
    }


# Fixed values. Asserted constraints: table, unique column, further columns free of NULLs.
_KEYS = (
    ("raw_companies", "hs_object_id", "properties", "_loaded_at"),
    ("raw_contacts", "hs_object_id", "properties", "_loaded_at"),
    ("raw_deals", "hs_object_id", "properties", "_loaded_at"),
    ("raw_line_items", "hs_object_id", "properties", "_loaded_at"),
    ("raw_products", "hs_object_id", "properties", "_loaded_at"),
    ("raw_lifecycle", "event_id", "properties", "_loaded_at"),
    ("raw_subscriptions", "subscription_id", "properties", "_loaded_at"),
    ("stg_companies", "company_id"),
    ("stg_contacts", "contact_id"),
    ("stg_deals", "deal_id"),
    ("stg_line_items", "line_item_id"),
    ("stg_products", "product_id"),
    ("stg_lifecycle", "event_id", "contact_id"),
    ("stg_subscriptions", "subscription_id", "deal_id"),
    ("links_contact_company", None, "contact_id", "company_id"),
    ("links_deal_company", None, "deal_id", "company_id"),
    ("links_line_item_deal", None, "line_item_id", "deal_id"),
    ("int_companies", "company_id"),
    ("int_contacts", "contact_id", "email"),
    ("int_deals", "deal_id", "amount_usd"),
    ("int_line_items", "line_item_id"),
    ("int_products", "product_id"),
    ("int_lifecycle", "event_id", "contact_id"),
    ("int_subscriptions", "subscription_id", "deal_id"),
    ("int_contact_company_primary", None, "contact_id", "company_id"),
    ("int_deal_company_primary", None, "deal_id", "company_id"),
    ("int_line_item_deal_primary", None, "line_item_id", "deal_id"),
    ("dim_accounts", "company_id"),
    ("dim_contacts", "contact_id", "email"),
    ("fct_deals", "deal_id", "amount_usd"),
    ("fct_pipeline", "stage_id"),
    ("fct_revenue", "subscription_id", "deal_id"),
    ("fct_funnel", "event_id", "contact_id"),
    ("fct_account_health", "company_id"),
)
# Asserted references: child table, child column, parent table, parent column.
_REFERENCES = (
    ("int_subscriptions", "deal_id", "int_deals", "deal_id"),
    ("dim_contacts", "company_id", "dim_accounts", "company_id"),
    ("fct_deals", "company_id", "dim_accounts", "company_id"),
    ("fct_revenue", "deal_id", "fct_deals", "deal_id"),
    ("fct_revenue", "company_id", "dim_accounts", "company_id"),
    ("fct_funnel", "contact_id", "dim_contacts", "contact_id"),
    ("fct_funnel", "company_id", "dim_accounts", "company_id"),
    ("fct_account_health", "company_id", "dim_accounts", "company_id"),
)


def _table(name: str) -> str:
    """RAW tables exist only as staging here: their blob is never NULL."""
    if not name.startswith("raw_"):
        return name
    entity = name[4:]
    key = {"companies": "company_id", "lifecycle": "event_id", "subscriptions": "subscription_id"}.get(
        entity, f"{entity[:-1]}_id"
    )
    return f"(SELECT {key} AS hs_object_id, {key} AS raw_key, 'x' AS properties, _loaded_at FROM stg_{entity})"


def _column(name: str, column: str) -> str:
    return "raw_key" if name.startswith("raw_") and column.endswith("_id") else column


def _check_sql() -> dict[str, str]:
    unique = [
        f"""SELECT 'unique:{t}.{key}' AS test, count(*) AS failures FROM
            (SELECT {_column(t, key)} FROM {_table(t)} WHERE {_column(t, key)} IS NOT NULL
             GROUP BY 1 HAVING count(*) > 1)"""
        for t, key, *_ in _KEYS
        if key
    ]
    not_null = [
        f"""SELECT 'not_null:{t}.{c}' AS test, count(*) AS failures FROM {_table(t)}
            WHERE {_column(t, c)} IS NULL"""
        for t, *columns in _KEYS
        for c in columns
        if c
    ]
    references = [
        f"""SELECT 'relationship:{child}.{c}->{parent}.{p}' AS test, count(*) AS failures FROM {child}
            WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p} FROM {parent})"""
        for child, c, parent, p in _REFERENCES
    ]
    in_range = """SELECT 'account_health_score_in_range' AS test, count(*) AS failures FROM fct_account_health
        WHERE account_health_score IS NULL OR account_health_score NOT BETWEEN 0 AND 100"""
    only_won = """SELECT 'revenue_only_won_deals' AS test, count(*) AS failures FROM fct_revenue r
        LEFT JOIN fct_deals d ON r.deal_id = d.deal_id WHERE NOT COALESCE(d.is_won, false)"""
    reconciled = f"""SELECT 'mrr_reconciliation' AS test, count(*) AS failures FROM fct_revenue
        WHERE abs(mrr_usd - (({_LIVE_MRR}) + churned_mrr_usd)) > 0.01"""
    passed = "SELECT test, failures, failures = 0 AS passed FROM ({})"
    fresh = [
        f"""SELECT '{entity}' AS source, max_loaded_at, round(age, 3) AS age_hours,
            CASE WHEN age > 48 THEN 'error' WHEN age > 25 THEN 'warn' ELSE 'pass' END AS status
            FROM (SELECT max(_loaded_at) AS max_loaded_at,
                         (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(_loaded_at))) / 3600000000.0 AS age
                  FROM stg_{entity})"""
        for entity in ("companies", "contacts", "deals", "line_items", "products", "lifecycle", "subscriptions")
    ]
    marts = ("dim_accounts", "dim_contacts", "fct_deals", "fct_pipeline", "fct_revenue", "fct_funnel", "fct_account_health")
    stored = [q for q in unique + not_null if any(f":{mart}." in q for mart in marts)]
    return {
        "dq_on_write": " UNION ALL ".join([*stored, in_range, reconciled]),
        "dq_unique": " UNION ALL ".join(unique),
        "dq_not_null": " UNION ALL ".join(not_null),
        "dq_keys": " UNION ALL ".join(unique + not_null),
        "dq_relationships": " UNION ALL ".join(references),
        "dq_health_range": in_range,
        "dq_revenue_only_won": only_won,
        "dq_mrr_reconciliation": reconciled,
        "dq_invariants": " UNION ALL ".join(passed.format(q) for q in (in_range, only_won, reconciled)),
        "dq_freshness": " UNION ALL ".join(fresh),
    }


# Fixed values. Per object the properties of its blob and the staging columns they carry.
_DATES = (("createdate", "created_at_hubspot"), ("hs_lastmodifieddate", "modified_at_hubspot"))
_PROPERTIES = {
    "companies": (
        ("name", "name"),
        ("domain", "domain"),
        ("industry", "industry"),
        ("numberofemployees", "employee_count"),
        ("annualrevenue", "annual_revenue_usd"),
        ("city", "city"),
        ("country", "country"),
        *_DATES,
    ),
    "contacts": (
        ("firstname", "first_name"),
        ("lastname", "last_name"),
        ("email", "email"),
        ("jobtitle", "job_title"),
        ("phone", "phone"),
        ("lifecyclestage", "lifecycle_stage"),
        *_DATES,
    ),
    "deals": (
        ("dealname", "deal_name"),
        ("amount", "amount_usd"),
        ("dealstage", "stage_id"),
        ("dealtype", "deal_type"),
        ("pipeline", "pipeline_id"),
        ("closedate", "close_date"),
        *_DATES,
    ),
    "line_items": (
        ("name", "product_name"),
        ("quantity", "quantity"),
        ("price", "unit_price_usd"),
        ("amount", "total_amount_usd"),
        ("hs_product_id", "product_id"),
        *_DATES,
    ),
    "products": (("name", "product_name"), ("price", "unit_price_usd"), ("hs_sku", "sku"), *_DATES),
}


def _observed_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{entity}' AS object_type, '{name}' AS name,
        CASE WHEN count({column}) > 0 THEN 'string' ELSE 'unknown' END AS type,
        'required' AS field_type FROM stg_{entity}"""
        for entity, pairs in _PROPERTIES.items()
        for name, column in pairs
    )


def _live_sql() -> str:
    """The observed contract after the change of the sources."""
    return f"""
        SELECT object_type,
               CASE WHEN object_type = 'deals' AND name = 'dealtype' THEN 'deal_kind' ELSE name END AS name,
               CASE WHEN object_type = 'deals' AND name = 'amount' THEN 'number|string' ELSE type END AS type,
               CASE WHEN object_type = 'deals' AND name = 'closedate' THEN 'optional' ELSE field_type END
                   AS field_type
        FROM ({_observed_sql()})
        UNION ALL SELECT 'products', 'currency', 'string', 'required'"""


def _diff_sql() -> str:
    return f"""
        SELECT COALESCE(b.object_type, l.object_type) AS object_type, COALESCE(b.name, l.name) AS name,
               CASE WHEN l.name IS NULL THEN 'removed' WHEN b.name IS NULL THEN 'added' ELSE 'changed' END AS change,
               b.type AS was_type, b.field_type AS was_field_type,
               l.type AS now_type, l.field_type AS now_field_type
        FROM ({_observed_sql()}) b FULL OUTER JOIN ({_live_sql()}) l
          ON b.object_type = l.object_type AND b.name = l.name
        WHERE b.name IS NULL OR l.name IS NULL OR b.type <> l.type OR b.field_type <> l.field_type"""


def _contract_sql() -> dict[str, str]:
    severity = """CASE WHEN count(*) FILTER (change IN ('removed', 'changed')) > 0 THEN '{}'
        WHEN count(change) > 0 THEN '{}' ELSE '{}' END"""
    return {
        "contract_observed": _observed_sql(),
        "contract_diff": _diff_sql(),
        "contract_schema": """SELECT 'deals' AS object_type, name, change, was_type, was_field_type, now_type, now_field_type
            FROM (SELECT count(*) = count(amount_usd) AS whole,
                         count_if(CAST(deal_id AS BIGINT) % 4 = 0) > 0 AS gaps FROM stg_deals),
                 LATERAL (VALUES
                ('amount_usd', 'removed', 'decimal(18,2)', CASE WHEN whole THEN 'required' ELSE 'optional' END, NULL, NULL),
                ('associations.companies.results[].id', 'changed', 'string', 'required', 'bigint', 'required'),
                ('associations.companies.results[].type', 'changed', 'string', 'required', 'string',
                 CASE WHEN gaps THEN 'optional' ELSE 'required' END),
                ('associations.companies.results[].labeled', 'added', NULL, NULL, 'boolean',
                 CASE WHEN gaps THEN 'optional' ELSE 'required' END),
                ('associations.companies.paging', 'added', NULL, NULL, 'struct', 'unseen'),
                ('associations.companies.paging.after', 'added', NULL, NULL, 'string', 'unseen'))
                AS changes(name, change, was_type, was_field_type, now_type, now_field_type)""",
        "contract_normalize": f"""SELECT l.* FROM ({_live_sql()}) l
            SEMI JOIN ({_observed_sql()}) b ON l.object_type = b.object_type AND l.name = b.name""",
        "contract_snapshot": _observed_sql(),
        "contract_status": f"""SELECT {severity.format("breaking", "informational", "none")} AS status,
            CAST({severity.format(1, 2, 0)} AS INTEGER) AS exit_code,
            count(*) FILTER (change = 'removed') AS removed, count(*) FILTER (change = 'changed') AS changed,
            count(*) FILTER (change = 'added') AS added FROM ({_diff_sql()})""",
        "contract_report": f"""SELECT t.object_type, COALESCE(d.status, 'OK') AS status, t.tracked,
            COALESCE(d.details, '') AS details
            FROM (SELECT object_type, count(*) AS tracked FROM ({_observed_sql()}) GROUP BY 1) t
            LEFT JOIN (SELECT object_type, {severity.format("FAIL", "WARN", "OK")} AS status,
                              string_agg(line, '; ' ORDER BY line) AS details
                       FROM (SELECT *, upper(change) || ' ' || name || CASE WHEN change = 'changed'
                                 THEN ' (' || was_type || '/' || was_field_type || ' -> ' || now_type || '/'
                                      || now_field_type || ')' ELSE '' END AS line
                             FROM ({_diff_sql()})) GROUP BY 1) d ON t.object_type = d.object_type""",
    }


# Deal links of RAW rows of which every third came twice, and their pairs.
_LINKS_TWICE = """
    SELECT * FROM links_deal_company
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey + d.step AS VARCHAR), d.kind, o_orderdate + INTERVAL 54 HOUR
    FROM orders, (VALUES (-1, 'deal_to_company_unlabeled'), (1, 'deal_to_company'), (0, NULL)) d(step, kind)
    WHERE o_orderkey % 3 = 0"""
# A labeled row wins; else a type before none, then the earlier load.
_PAIRS_TWICE = f"""
    SELECT deal_id, company_id, bool_or(COALESCE(link_type = 'deal_to_company', false)) AS labeled,
           min(_loaded_at) FILTER (link_type = 'deal_to_company') AS labeled_at,
           min(link_type) FILTER (link_type <> 'deal_to_company') AS other,
           COALESCE(min(_loaded_at) FILTER (link_type <> 'deal_to_company'), min(_loaded_at)) AS other_at
    FROM ({_LINKS_TWICE}) GROUP BY deal_id, company_id"""


def _raw_sql() -> dict[str, str]:
    again = """SELECT deal_id, CASE WHEN {later} THEN deal_name || ' (again)' ELSE deal_name END AS deal_name,
        amount_usd, CASE WHEN {later} THEN _loaded_at + INTERVAL 10 DAY ELSE _loaded_at END AS _loaded_at
        FROM stg_deals"""
    # Merged: everything whose second load is past the newest first load before 2000.
    mark = "(SELECT max(_loaded_at) FROM stg_deals WHERE _loaded_at < TIMESTAMP '2000-01-01')"
    return {
        "raw_upsert_entity": again.format(later="close_date >= TIMESTAMP '1999-07-01'"),
        "raw_upsert_subscriptions": """SELECT subscription_id, amount_usd,
            CASE WHEN started_at >= TIMESTAMP '1999-01-01' THEN 'churned' ELSE status END AS status
            FROM stg_subscriptions""",
        "incremental_upsert": again.format(later=f"_loaded_at + INTERVAL 10 DAY > {mark}"),
        "stream_upsert": """SELECT CAST(o_orderkey AS VARCHAR) AS deal_id,
            CASE WHEN o_orderkey % 2 = 1 THEN 'U' ELSE o_orderstatus END AS status,
            CAST(o_totalprice AS DECIMAL(18,2)) AS amount_usd,
            o_orderdate + CASE WHEN o_orderkey % 2 = 1 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS updated_at
            FROM orders""",
        "ingest_subscriptions": "SELECT * EXCLUDE (_loaded_at) FROM stg_subscriptions",
        "ingest_lifecycle": """SELECT CAST(t.id AS VARCHAR) || '_' || stage AS event_id,
            CAST(t.id AS VARCHAR) AS contact_id, stage AS lifecycle_stage, max(ts) AS entered_at,
            TIMESTAMP '2024-02-01 12:00:00' AS _loaded_at
            FROM touches t WHERE t.id % 31 <> 0 GROUP BY t.id, stage""",
        "stage_metadata": """SELECT CAST(r_regionkey AS VARCHAR) AS pipeline_id, r_name AS pipeline_label,
            CAST(n_nationkey AS VARCHAR) AS stage_id, n_name AS stage_label,
            CAST(n_nationkey AS INTEGER) AS display_order,
            CAST(CAST(n_nationkey / 100 AS DECIMAL(4,2)) AS VARCHAR) AS probability,
            CASE WHEN n_nationkey % 5 = 0 THEN 'true' ELSE 'false' END AS is_closed
            FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "raw_text_blobs": """SELECT deal_id,
            CASE WHEN o.keep THEN deal_name END AS deal_name, CASE WHEN o.keep THEN amount_usd END AS amount_usd,
            CASE WHEN o.keep THEN stage_id END AS stage_id, CASE WHEN o.keep THEN deal_type END AS deal_type,
            CASE WHEN o.keep THEN close_date END AS close_date,
            CASE WHEN o.keep THEN created_at_hubspot END AS created_at_hubspot,
            CASE WHEN o.keep THEN modified_at_hubspot END AS modified_at_hubspot, _loaded_at
            FROM (SELECT *, CAST(deal_id AS BIGINT) % 3 <> 0 AS keep FROM stg_deals) o""",
        "view_sql": """SELECT a.country, count(DISTINCT d.deal_id) AS deals,
            CAST(sum(d.amount_usd) AS DECIMAL(28,2)) AS won_usd,
            count(DISTINCT s.subscription_id) AS subscriptions
            FROM dim_accounts a JOIN fct_deals d ON d.company_id = a.company_id
            LEFT JOIN int_subscriptions s ON s.deal_id = d.deal_id WHERE d.is_won GROUP BY a.country""",
        "links_deal_company_across_rows": f"""SELECT deal_id, company_id,
            CASE WHEN labeled THEN 'deal_to_company' ELSE other END AS link_type,
            CASE WHEN labeled THEN labeled_at ELSE other_at END AS _loaded_at
            FROM ({_PAIRS_TWICE})""",
        "int_deal_company_across_rows": f"""SELECT deal_id, company_id, _loaded_at FROM (
            SELECT *, row_number() OVER (PARTITION BY deal_id ORDER BY
                       CASE WHEN link_type = 'deal_to_company' THEN 0 ELSE 1 END, company_id, _loaded_at) AS rn
            FROM ({_LINKS_TWICE})) WHERE rn = 1""",
        "int_contacts_across_rows": "SELECT * FROM int_contacts",
        "ingest_pages": "SELECT * FROM stg_companies",
        "incremental_account_health": "SELECT * FROM fct_account_health",
        "ingest_page_chain": """SELECT unnest(range((n + 99) // 100 + 1)) AS position,
            greatest(0, least(100, n - 100 * unnest(range((n + 99) // 100 + 1)))) AS records, n AS loaded, n AS stored
            FROM (SELECT count(*) AS n FROM stg_companies)""",
        "stream_pages": """SELECT * REPLACE (CASE WHEN CAST(company_id AS BIGINT) % 2 = 1 AND CAST(company_id AS BIGINT) % 7 <> 0
            THEN name || ' (new)' ELSE name END AS name) FROM stg_companies""",
        "revenue_of_quarter": f"""SELECT metric_month, count(DISTINCT company_id) AS companies, count(*) AS subscriptions,
            CAST(sum(mrr_usd) AS DECIMAL(38,2)) AS mrr_usd, CAST(sum(churned_mrr_usd) AS DECIMAL(38,2)) AS churned_mrr_usd,
            CAST(sum({_LIVE_ARR}) AS DECIMAL(38,2)) AS active_arr_usd FROM fct_revenue
            WHERE year(metric_month) = 1998 AND quarter(metric_month) = 2 GROUP BY metric_month""",
        "table_evolution": """SELECT deal_id,
            CASE WHEN created_at_hubspot >= TIMESTAMP '1995-01-01' THEN c.company_id END AS company_id,
            amount_usd, created_at_hubspot, d._loaded_at
            FROM stg_deals d LEFT JOIN int_deal_company_primary c USING (deal_id)""",
        "lifecycle_id_resolution": """SELECT CAST(t.id AS VARCHAR) || '_' || stage AS event_id,
            CAST(t.id AS VARCHAR) AS contact_id, stage AS lifecycle_stage, max(ts) AS entered_at,
            TIMESTAMP '2024-02-01 12:00:00' AS _loaded_at
            FROM touches t WHERE t.id % 31 <> 0 GROUP BY t.id, stage""",
        "lifecycle_unmapped": "SELECT count(*) AS skipped FROM touches WHERE id % 31 = 0",
        "won_deal_scan": """SELECT deal_id, amount_usd AS acv_usd, close_date FROM stg_deals
            WHERE stage_id = 'closedwon' AND amount_usd IS NOT NULL""",
        "export_scan": """SELECT company_id, arr_usd, open_pipeline_usd, account_health_score
            FROM fct_account_health""",
        "reverse_etl_payload": "SELECT company_id, payload FROM payloads",
        "reverse_etl_batches": """SELECT CAST(no // 100 AS BIGINT) AS batch_no, count(*) AS batch_size,
            '{"inputs":[' || string_agg(payload, ',' ORDER BY no) || ']}' AS body
            FROM (SELECT payload, row_number() OVER (ORDER BY md5(company_id), company_id) - 1 AS no FROM payloads)
            GROUP BY 1""",
    }


def all_sql() -> dict[str, str]:
    plain = [
        name
        for name in _BLOCKS
        if name not in ("touches", "people", "health_scored", "funnel_by_stage", "payloads")
    ]
    finals = {name: f"SELECT * FROM {name}" for name in plain}
    for name in ("raw_to_account_health", "stored_account_health", "copartitioned_account_health"):
        finals[name] = "SELECT * FROM fct_account_health"
    for group in (_metric_sql(), _report_sql(), _check_sql(), _contract_sql(), _raw_sql()):
        finals.update(group)
    return {name: _query(final) for name, final in finals.items()}
