"""DuckDB SQL for every named query, over the driver's pre-registered tables.

Written independently of the Spark plans, in the shape of the original job:
three resolution branches joined level by level and combined with ``UNION``,
two separate aggregates (totals; dead rows filtered first) joined back with
two left joins, a full outer join of per-batch totals and dead counts, and the
stream state computed with window functions over the batch order rather than
``min_by``. Agreement with the Spark plans therefore checks the flattened
lookup, the single-pass aggregate and the fold against the original shapes.
"""

from __future__ import annotations

import re


def _s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


CN = """cn AS (
  SELECT c.c_custkey, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

REGIONS = f"""raw_regions AS (
  SELECT 'C' || {_s('r_regionkey')} AS region_doc_id, r_name AS region_name,
         'COUNTRY' AS region_type, CAST(NULL AS VARCHAR) AS parentRegionId FROM region
  UNION ALL
  SELECT 'R' || {_s('n_nationkey')}, n_name, 'REGION', 'C' || {_s('n_regionkey')} FROM nation
  UNION ALL
  SELECT 'R99', 'NO_MEMBERS', 'REGION', 'C' || {_s('r_regionkey')} FROM region WHERE r_regionkey = 0
  UNION ALL
  SELECT DISTINCT 'T' || {_s('c_nationkey')} || '-' || c_mktsegment,
         concat_ws('/', n_name, c_mktsegment), 'CITY', 'R' || {_s('c_nationkey')} FROM cn
  UNION ALL
  SELECT DISTINCT 'D' || {_s('c_nationkey')} || '-' || c_mktsegment || '-' || {_s('c_custkey % 3')},
         concat_ws('/', n_name, c_mktsegment, {_s('c_custkey % 3')}), 'DISTRICT',
         'T' || {_s('c_nationkey')} || '-' || c_mktsegment FROM cn),
lvl_r AS (SELECT * FROM raw_regions WHERE region_type = 'REGION'),
lvl_c AS (SELECT * FROM raw_regions WHERE region_type = 'CITY'),
lvl_d AS (SELECT * FROM raw_regions WHERE region_type = 'DISTRICT')"""

UBASE = f"""ubase AS (
  SELECT c_custkey,
    'U' || {_s('c_custkey')} AS user_doc_id,
    CASE WHEN c_custkey % 10 <= 3
           THEN 'D' || {_s('c_nationkey')} || '-' || c_mktsegment || '-' || {_s('c_custkey % 3')}
         WHEN c_custkey % 10 = 9 THEN 'D-missing' END AS districtId,
    CASE WHEN c_custkey % 10 IN (4, 5) THEN 'T' || {_s('c_nationkey')} || '-' || c_mktsegment
         WHEN c_custkey % 10 IN (6, 7, 9) THEN 'R' || {_s('c_nationkey')} END AS regionId,
    'C' || {_s('n_regionkey')} AS countryId,
    CASE WHEN c_custkey % 50 = 7 THEN CAST(NULL AS BOOLEAN) ELSE c_acctbal >= 0 END AS active
  FROM cn)"""

USERS = """users AS (
  SELECT user_doc_id, regionId, districtId, countryId, active FROM ubase
  UNION ALL
  SELECT user_doc_id, regionId, districtId, countryId, active FROM ubase WHERE c_custkey % 20 = 0
  UNION ALL
  SELECT user_doc_id, regionId, districtId, countryId, NOT active FROM ubase WHERE c_custkey % 60 = 4)"""

BATCH_OF_DAY = "CAST(date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE)) AS BIGINT) AS batch_id"
CHANGES = f"""changes AS (
  SELECT b.user_doc_id, b.regionId, b.districtId, b.countryId,
         e.event_type <> 'error' AS active,
         {BATCH_OF_DAY}
  FROM events e JOIN ubase b ON e.user_id = b.c_custkey)"""


def _branches(src: str, name: str, extra: str = "") -> str:
    """The three resolution branches over relation ``src``; ``extra`` carries columns."""
    pre = f"u.{extra}, " if extra else ""
    out = "u.user_doc_id, u.active, r.region_doc_id AS effective_region_id, r.region_name AS effective_region_name"
    return f"""{name}_district AS (
  SELECT {pre}{out} FROM {src} u
  JOIN lvl_d d ON u.districtId = d.region_doc_id
  JOIN lvl_c c ON d.parentRegionId = c.region_doc_id
  JOIN lvl_r r ON c.parentRegionId = r.region_doc_id
  WHERE u.districtId IS NOT NULL),
{name}_city AS (
  SELECT {pre}{out} FROM {src} u
  JOIN lvl_c c ON u.regionId = c.region_doc_id
  JOIN lvl_r r ON c.parentRegionId = r.region_doc_id
  WHERE u.regionId IS NOT NULL AND u.districtId IS NULL),
{name}_region AS (
  SELECT {pre}{out} FROM {src} u
  JOIN lvl_r r ON u.regionId = r.region_doc_id
  WHERE u.regionId IS NOT NULL AND u.districtId IS NULL),
{name} AS (
  SELECT * FROM {name}_district UNION SELECT * FROM {name}_city UNION SELECT * FROM {name}_region)"""


RATE = (
    "CASE WHEN {t} > 0 THEN CAST({d} AS DOUBLE) * CAST(100.0 AS DOUBLE) / {t} "
    "ELSE CAST(0.0 AS DOUBLE) END"
)

REPORT = f"""totals AS (
  SELECT effective_region_id, effective_region_name, COUNT(user_doc_id) AS total_population
  FROM mapped GROUP BY effective_region_id, effective_region_name),
deads AS (
  SELECT effective_region_id, effective_region_name, COUNT(user_doc_id) AS dead_population
  FROM mapped WHERE active = false GROUP BY effective_region_id, effective_region_name),
report_counts AS (
  SELECT r.region_doc_id AS region_id, r.region_name, r.parentRegionId AS parent_country_id,
         COALESCE(t.total_population, 0) AS total_population,
         COALESCE(x.dead_population, 0) AS dead_population
  FROM lvl_r r
  LEFT JOIN totals t ON r.region_doc_id = t.effective_region_id
  LEFT JOIN deads x ON r.region_doc_id = x.effective_region_id),
report AS (
  SELECT region_id, region_name, 'REGION' AS region_type, parent_country_id,
         CAST(total_population AS BIGINT) AS total_population,
         CAST(dead_population AS BIGINT) AS dead_population,
         {RATE.format(t='total_population', d='dead_population')} AS mortality_rate_percent
  FROM report_counts)"""

DELTAS = """ch_totals AS (
  SELECT batch_id, effective_region_id, effective_region_name, COUNT(user_doc_id) AS total_population_change
  FROM ch_mapped GROUP BY batch_id, effective_region_id, effective_region_name),
ch_deads AS (
  SELECT batch_id, effective_region_id, effective_region_name, COUNT(user_doc_id) AS dead_population_change
  FROM ch_mapped WHERE active = false GROUP BY batch_id, effective_region_id, effective_region_name),
deltas AS (
  SELECT COALESCE(t.batch_id, x.batch_id) AS batch_id,
         COALESCE(t.effective_region_id, x.effective_region_id) AS effective_region_id,
         COALESCE(t.effective_region_name, x.effective_region_name) AS effective_region_name,
         CAST(COALESCE(t.total_population_change, 0) AS BIGINT) AS total_population_change,
         CAST(COALESCE(x.dead_population_change, 0) AS BIGINT) AS dead_population_change
  FROM ch_totals t FULL OUTER JOIN ch_deads x
    ON t.batch_id = x.batch_id AND t.effective_region_id = x.effective_region_id
   AND t.effective_region_name = x.effective_region_name),
deltas_parent AS (
  SELECT d.*, p.parentRegionId AS parent_country_id_source
  FROM deltas d LEFT JOIN lvl_r p ON d.effective_region_id = p.region_doc_id)"""


def _stream_state(src: str, name: str) -> str:
    """First delta per REGION (by batch) and the summed dead change, from ``src``."""
    return f"""{name}_ranked AS (
  SELECT effective_region_id,
         FIRST_VALUE(total_population_change) OVER w AS first_total,
         FIRST_VALUE(effective_region_name) OVER w AS first_name,
         FIRST_VALUE(parent_country_id_source) OVER w AS first_parent,
         SUM(dead_population_change) OVER (PARTITION BY effective_region_id) AS dead_sum,
         ROW_NUMBER() OVER w AS rn
  FROM {src}
  WINDOW w AS (PARTITION BY effective_region_id ORDER BY batch_id)),
{name} AS (SELECT * FROM {name}_ranked WHERE rn = 1)"""


def _over_baseline(state: str, rate: str = RATE) -> str:
    total = "CASE WHEN b.region_id IS NOT NULL THEN b.total_population ELSE f.first_total END"
    dead = (
        "CASE WHEN b.region_id IS NOT NULL THEN b.dead_population + COALESCE(f.dead_sum, 0) "
        "ELSE f.dead_sum END"
    )
    return f"""SELECT COALESCE(b.region_id, f.effective_region_id) AS region_id,
       CASE WHEN b.region_id IS NOT NULL THEN b.region_name ELSE f.first_name END AS region_name,
       CASE WHEN b.region_id IS NOT NULL THEN b.region_type ELSE 'REGION' END AS region_type,
       CASE WHEN b.region_id IS NOT NULL THEN b.parent_country_id ELSE f.first_parent END AS parent_country_id,
       CAST({total} AS BIGINT) AS total_population,
       CAST({dead} AS BIGINT) AS dead_population,
       CASE WHEN f.effective_region_id IS NULL THEN b.mortality_rate_percent
            ELSE {rate.format(t=f'({total})', d=f'({dead})')} END AS mortality_rate_percent
FROM report b FULL OUTER JOIN {state} f ON b.region_id = f.effective_region_id"""


def _from_empty(state: str) -> str:
    return f"""SELECT effective_region_id AS region_id, first_name AS region_name, 'REGION' AS region_type,
       first_parent AS parent_country_id, CAST(first_total AS BIGINT) AS total_population,
       CAST(dead_sum AS BIGINT) AS dead_population,
       {RATE.format(t='first_total', d='dead_sum')} AS mortality_rate_percent
FROM {state}"""


def _with(*ctes: str) -> str:
    """WITH clause; every relation is computed once, whatever number of others read it."""
    return "WITH " + ",\n".join(re.sub(r"^(\w+) AS \(", r"\1 AS MATERIALIZED (", c, flags=re.M) for c in ctes) + "\n"


USERS_CTES = (CN, REGIONS, UBASE, USERS)
MAPPED_CTES = (*USERS_CTES, _branches("users", "mapped"))
REPORT_CTES = (*MAPPED_CTES, REPORT)
CHANGE_CTES = (*REPORT_CTES, CHANGES, _branches("changes", "ch_mapped", "batch_id"), DELTAS)

REPORT_SQL = _with(*REPORT_CTES) + "SELECT * FROM report"
AFTER_EMPTY_SQL = _with(*CHANGE_CTES, _stream_state("deltas_parent", "state")) + _from_empty("state")
AFTER_BASELINE_SQL = _with(*CHANGE_CTES, _stream_state("deltas_parent", "state")) + _over_baseline("state")
TOP_AFTER_BASELINE_SQL = (
    "SELECT region_id, region_name, total_population, dead_population, mortality_rate_percent FROM ("
    + AFTER_BASELINE_SQL
    + ") ORDER BY mortality_rate_percent DESC, total_population DESC, region_id ASC LIMIT 20"
)
MAPPED_COLS = "user_doc_id, active, effective_region_id, effective_region_name"


#: The rate as decimal(38, 14), rounded half up, then read as a double.
DECIMAL_RATE = (
    "CASE WHEN {t} > 0 THEN CAST(CAST(({d} * CAST(20000000000000000 AS HUGEINT) + {t}) // (2 * CAST({t} AS HUGEINT)) "
    "// 100000000000000 AS VARCHAR) || '.' || lpad(CAST(({d} * CAST(20000000000000000 AS HUGEINT) + {t}) "
    "// (2 * CAST({t} AS HUGEINT)) % 100000000000000 AS VARCHAR), 14, '0') AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"
)


def _batches(sql: str, expr: str) -> str:
    """``sql`` with the batches of the changes given by an expression of the day."""
    day = BATCH_OF_DAY.removesuffix(" AS batch_id")
    return sql.replace(BATCH_OF_DAY, f"CAST({expr.format(day=day)} AS BIGINT) AS batch_id")


SKIPS_SQL = (
    _with(*USERS_CTES, CHANGES, _branches("changes", "ch_mapped", "batch_id"))
    + """, split AS (
  SELECT user_doc_id, 2 * (batch_id // 7)
         + CASE WHEN COALESCE(districtId, regionId) IS NULL OR districtId = 'D-missing' THEN 1 ELSE 0 END AS part
  FROM changes),
parts AS (SELECT part, ROW_NUMBER() OVER (ORDER BY part) - 1 AS batch_id FROM (SELECT DISTINCT part FROM split)),
regions_of AS (
  SELECT 2 * (batch_id // 7) AS part, COUNT(DISTINCT effective_region_id) AS n FROM ch_mapped GROUP BY 1)
SELECT CAST(p.batch_id AS BIGINT) AS batch_id, CAST(COALESCE(r.n, 0) AS BIGINT) AS n_delta_rows,
       COALESCE(r.n, 0) > 0 AS reported
FROM parts p LEFT JOIN regions_of r ON p.part = r.part"""
).replace("\n, split", ",\nsplit")

ENVELOPE = f"""envelopes AS (
  SELECT e.event_id, {BATCH_OF_DAY}, b.*,
         CASE WHEN e.event_id % 50 = 7 THEN 'malformed'
              WHEN e.event_type = 'error' OR b.c_custkey IS NULL THEN 'no_document' ELSE 'document' END AS kind
  FROM events e LEFT JOIN ubase b ON e.user_id = b.c_custkey)"""


def oracle_sql() -> dict[str, str]:
    return {
        "scan_users": _with(*USERS_CTES) + "SELECT user_doc_id, regionId, districtId, countryId, active FROM users",
        "scan_regions": _with(CN, REGIONS)
        + "SELECT region_doc_id, region_name, region_type, parentRegionId FROM raw_regions",
        "regions_by_level": _with(CN, REGIONS)
        + "SELECT region_type, region_doc_id, region_name, parentRegionId FROM raw_regions "
        "WHERE region_type IN ('REGION', 'CITY', 'DISTRICT')",
        "users_via_district": _with(*MAPPED_CTES) + "SELECT * FROM mapped_district",
        "users_via_city": _with(*MAPPED_CTES) + "SELECT * FROM mapped_city",
        "users_via_region": _with(*MAPPED_CTES) + "SELECT * FROM mapped_region",
        "users_mapped": _with(*MAPPED_CTES) + f"SELECT {MAPPED_COLS} FROM mapped",
        "users_mapped_large_tree": _with(*MAPPED_CTES) + f"SELECT {MAPPED_COLS} FROM mapped",
        "users_mapped_by_branches": _with(*MAPPED_CTES) + f"SELECT {MAPPED_COLS} FROM mapped",
        "preview_mapped": _with(*MAPPED_CTES)
        + f"SELECT {MAPPED_COLS} FROM mapped ORDER BY user_doc_id ASC NULLS LAST, active ASC NULLS LAST, "
        "effective_region_id ASC NULLS LAST, effective_region_name ASC NULLS LAST LIMIT 10",
        "total_population": _with(*REPORT_CTES) + "SELECT * FROM totals",
        "dead_population": _with(*REPORT_CTES) + "SELECT * FROM deads",
        "report_base": _with(CN, REGIONS)
        + "SELECT region_doc_id AS region_id, region_name, parentRegionId AS parent_country_id FROM lvl_r",
        "mortality_report": REPORT_SQL,
        "mortality_report_large_tree": REPORT_SQL,
        "mortality_report_branch_shape": REPORT_SQL,
        "top20_regions": _with(*REPORT_CTES)
        + "SELECT region_id, region_name, total_population, dead_population, mortality_rate_percent "
        "FROM report ORDER BY mortality_rate_percent DESC, total_population DESC, region_id ASC LIMIT 20",
        "region_parents": _with(CN, REGIONS)
        + "SELECT region_doc_id AS effective_region_id, parentRegionId AS parent_country_id_source FROM lvl_r",
        "batch_deltas": _with(*CHANGE_CTES)
        + "SELECT batch_id, effective_region_id, effective_region_name, total_population_change, "
        "dead_population_change FROM deltas",
        "batch_deltas_with_parent": _with(*CHANGE_CTES) + "SELECT * FROM deltas_parent",
        "merge_one_batch": _with(
            *CHANGE_CTES,
            _stream_state("(SELECT * FROM deltas_parent WHERE batch_id = 0)", "state"),
        )
        + _over_baseline("state"),
        "report_after_stream_with_baseline": AFTER_BASELINE_SQL,
        "report_after_stream_empty": AFTER_EMPTY_SQL,
        "top20_after_stream": TOP_AFTER_BASELINE_SQL,
        "stream_users_to_report": AFTER_EMPTY_SQL,
        "emptiness_probes": _with(*CHANGE_CTES)
        + """SELECT 'users' AS relation, NOT EXISTS (SELECT 1 FROM users) AS is_empty
UNION ALL SELECT 'regions', NOT EXISTS (SELECT 1 FROM raw_regions)
UNION ALL SELECT 'users_mapped', NOT EXISTS (SELECT 1 FROM mapped)
UNION ALL SELECT 'change_batch_0', NOT EXISTS (SELECT 1 FROM changes WHERE batch_id = 0)
UNION ALL SELECT 'country_only_users_mapped',
  NOT EXISTS (SELECT 1 FROM mapped m JOIN users u ON m.user_doc_id = u.user_doc_id
              WHERE u.districtId IS NULL AND u.regionId IS NULL)
UNION ALL SELECT 'batch_0_deltas', NOT EXISTS (SELECT 1 FROM deltas WHERE batch_id = 0)""",
        "side_table_counts": _with(CN, REGIONS)
        + """SELECT 'regions' AS relation, CAST(COUNT(*) AS BIGINT) AS row_count FROM raw_regions
UNION ALL SELECT 'region_parents', CAST(COUNT(*) AS BIGINT) FROM lvl_r""",
        "sink_replace_report": REPORT_SQL,
        "sink_create_if_absent": REPORT_SQL,
        "report_state_compacted": AFTER_BASELINE_SQL,
        "report_state_refreshed": REPORT_SQL,
        "stream_to_table": AFTER_EMPTY_SQL,
        "sink_failed_replace": REPORT_SQL,
        "users_mapped_hot_anchors": _with(*MAPPED_CTES) + f"SELECT {MAPPED_COLS} FROM mapped",
        "upsert_table": AFTER_BASELINE_SQL,
        "upsert_table_replayed": AFTER_EMPTY_SQL,
        "stats_from_table": _batches(TOP_AFTER_BASELINE_SQL, "{day} // 6"),
        "report_after_stream_decimal": _with(*CHANGE_CTES, _stream_state("deltas_parent", "state"))
        + _over_baseline("state", DECIMAL_RATE),
        # the refused first batch comes after all others
        "stream_dead_letters": _batches(AFTER_EMPTY_SQL, "CASE WHEN {day} // 6 = 0 THEN 1000 ELSE {day} // 6 END"),
        "stream_skip_rules": SKIPS_SQL,
        "change_envelope_counts": _with(CN, UBASE, ENVELOPE)
        + """SELECT batch_id, COUNT(CASE WHEN kind = 'document' THEN 1 END) AS n_documents,
       COUNT(CASE WHEN kind = 'no_document' THEN 1 END) AS n_without_document,
       COUNT(CASE WHEN kind = 'malformed' THEN 1 END) AS n_malformed
FROM envelopes GROUP BY batch_id""",
        "change_envelope_documents": _with(CN, UBASE, ENVELOPE)
        + "SELECT event_id, user_doc_id, regionId, districtId, active FROM envelopes WHERE kind = 'document'",
    }
