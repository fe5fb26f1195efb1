"""DuckDB SQL equivalents of the warehouse queries (correctness oracle).

Each string runs on DuckDB with the driver tables registered as views and must
return the same column names and values as the Spark query of the same key.
Shared CTEs are composed from the fragments below.
"""

from __future__ import annotations

from skuflow.plans.channels import SHOPIFY_BUCKETS
from skuflow.plans.warehouse import (
    ALLOWED_STATUSES, CHANNELS, EXCLUDED_STATUS, FBT_PRIORITIES, FLAG_CHANNEL, INVENTORY_CHANNELS, PAID_STATUS,
    PAYLOAD_CHUNKS, ROLLUP_FROM, ROLLUP_TO, RUN_DATE, RUN_TIMESTAMP, SOURCE_FILES, SOURCE_NAMES, UNMAPPED_MIN_SIZE,
)
from skuflow.sources.landed import SHOPIFY_SOURCE_TO_CHANNEL

_CH_VALUES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(CHANNELS))

LINES = f"""lines AS (
  SELECT cast(l.l_partkey AS VARCHAR) AS source_key, o.o_orderpriority AS channel,
         cast(o.o_orderdate AS DATE) AS d, l.l_quantity AS q, cast(l.l_extendedprice AS DECIMAL(18,2)) AS r
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE o.o_orderstatus IS DISTINCT FROM '{EXCLUDED_STATUS}')"""

KEYED = """keyed AS (
  SELECT source_key, channel, sum(q) AS qty, sum(r) AS rev, count(*) AS nrows, max(d) AS d
  FROM lines GROUP BY source_key, channel)"""

MAPPING = f"""m AS (
  SELECT cast(p_partkey AS VARCHAR) AS source_key,
         CASE WHEN p_type = 'PROMO' THEN [p_brand, p_brand]
              WHEN p_type = 'SMALL' THEN [p_brand, p_type]
              WHEN p_type = 'LARGE' THEN [p_brand, p_brand, p_brand]
              ELSE [p_brand] END AS targets
  FROM part WHERE p_size < {UNMAPPED_MIN_SIZE})"""

JOINED = """j AS (SELECT k.*, m.targets, len(m.targets) AS bs FROM keyed k JOIN m USING (source_key))"""

SALES = """e AS (SELECT channel, unnest(targets) AS sku, qty,
                  cast(cast(rev AS DOUBLE) / bs AS DECIMAL(18,4)) AS rev FROM j),
sales AS (SELECT channel, sku, sum(qty) AS units, sum(rev) AS revenue FROM e GROUP BY channel, sku)"""

BUNDLES = """bund AS (SELECT channel, sum(qty) AS units, sum(rev) AS revenue FROM j WHERE bs > 1 GROUP BY channel)"""

GRID = f"""ch AS (SELECT * FROM (VALUES {_CH_VALUES}) t(channel_rank, channel)),
skus AS (SELECT DISTINCT p_brand AS sku FROM part),
cd AS (SELECT channel, max(d) AS d FROM j GROUP BY channel),
grid AS (SELECT ch.channel, s.sku, coalesce(cd.d, DATE '{RUN_DATE}') AS d
         FROM ch CROSS JOIN skus s LEFT JOIN cd ON cd.channel = ch.channel),
bgrid AS (SELECT ch.channel, 'Bundles' AS sku, coalesce(cd.d, DATE '{RUN_DATE}') AS d
          FROM ch LEFT JOIN cd ON cd.channel = ch.channel)"""

REPORT = f"""body AS (
  SELECT g.channel, g.sku, g.d, coalesce(s.units, 0) AS units,
         cast(coalesce(s.revenue, 0) AS DECIMAL(38,4)) AS revenue
  FROM grid g LEFT JOIN sales s ON s.channel = g.channel AND s.sku = g.sku
  UNION ALL
  SELECT g.channel, g.sku, g.d, coalesce(b.units, 0), cast(coalesce(b.revenue, 0) AS DECIMAL(38,4))
  FROM bgrid g LEFT JOIN bund b ON b.channel = g.channel),
report AS (
  SELECT strftime(DATE '{RUN_DATE}', '%Y%m%d') || '_' || replace(channel, ' ', '_') || '_' || sku AS id,
         replace(channel, ' ', '_') || '_' || sku AS sku_channel_id,
         d AS "Date", sku AS "SKU", channel AS "Channel",
         cast(trunc(units) AS BIGINT) AS "Units",
         cast(round_even(cast(revenue AS DECIMAL(38,4)), 2) AS DOUBLE) AS "Revenue"
  FROM body)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


MAPPED = (LINES, KEYED, MAPPING, JOINED)

SQL = {
    "sales_by_sku_channel": _with(*MAPPED, SALES)
    + 'SELECT channel AS "Channel", sku AS "SKU", units AS "Units", cast(revenue AS DOUBLE) AS "Revenue" FROM sales',

    "sales_report_zero_filled": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT) + "SELECT * FROM report",

    "sales_report_wide": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT)
    + 'SELECT "SKU", '
    + ", ".join(
        f"cast(sum(CASE WHEN \"Channel\" = '{c}' THEN \"Units\" ELSE 0 END) AS BIGINT) AS \"{c} (Units)\", "
        f"sum(CASE WHEN \"Channel\" = '{c}' THEN \"Revenue\" ELSE 0.0 END) AS \"{c} (Revenue)\""
        for c in CHANNELS)
    + " FROM report WHERE \"SKU\" <> 'Bundles' GROUP BY \"SKU\"",

    "bundle_rows": _with(*MAPPED, BUNDLES)
    + 'SELECT channel AS "Channel", units AS "Units", cast(revenue AS DOUBLE) AS "Revenue" FROM bund',

    "unmapped_keys": _with(LINES, KEYED, MAPPING)
    + 'SELECT channel AS "Channel", source_key, qty AS "Units", cast(rev AS DOUBLE) AS "Revenue", '
      'cast(nrows AS BIGINT) AS "rows" FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.source_key = k.source_key)',

    "missing_skus_by_channel": _with(*MAPPED, SALES, GRID)
    + """, present AS (SELECT channel, sku FROM sales WHERE channel IN (SELECT channel FROM ch))
SELECT channel AS "Channel", sku AS "SKU", 'missing' AS issue FROM (SELECT channel, sku FROM grid EXCEPT SELECT channel, sku FROM present)
UNION ALL
SELECT channel, sku, 'unknown' FROM present p WHERE NOT EXISTS (SELECT 1 FROM skus s WHERE s.sku = p.sku)""",
}

_CATALOG = f"SELECT cast(p_partkey AS VARCHAR) AS sku FROM part WHERE p_size < {UNMAPPED_MIN_SIZE}"


def _violations(table: str, rules: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{col}' AS \"column\", '{rule}' AS rule, "
        f"cast(sum(CASE WHEN coalesce({valid}, false) THEN 0 ELSE 1 END) AS BIGINT) AS violations FROM {table}"
        for col, rule, valid in rules)


SQL.update({
    "status_substring_filter":
        "SELECT o_orderkey, o_orderpriority FROM orders "
        "WHERE NOT coalesce(contains(lower(trim(o_orderpriority)), 'low'), false)",

    "null_safe_not_equal":
        "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status FROM orders "
        "WHERE nullif(o_orderstatus, 'F') IS DISTINCT FROM 'O'",

    "status_exact_filter":
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",

    "either_positive_filter":
        "SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS units FROM lineitem "
        "WHERE l_discount > 0.05 OR l_tax > 0.05 GROUP BY l_returnflag, l_linestatus",

    "membership_semi":
        "SELECT l_returnflag, count(*) AS lines, sum(l_quantity) AS units FROM lineitem "
        "WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') GROUP BY l_returnflag",

    "sku_suffix_normalize": """WITH raw AS (
  SELECT CASE WHEN p_type = 'PROMO' THEN p_brand || 's' ELSE p_brand END AS raw_key, p_size,
         cast(floor(p_retailprice) AS BIGINT) AS pf FROM part),
allowed AS (SELECT p_brand AS k FROM part UNION SELECT p_brand || 's' FROM part WHERE p_type = 'PROMO' AND p_size < 10)
SELECT regexp_replace(raw_key, 's$', '') AS "SKU", cast(sum(p_size) AS BIGINT) AS "Units",
       cast(sum(p_size + pf) AS BIGINT) AS "Inventory"
FROM raw WHERE raw_key IN (SELECT k FROM allowed) GROUP BY 1""",

    "row_wise_sum":
        "SELECT l_orderkey, l_linenumber, coalesce(l_quantity, 0) + coalesce(l_tax, 0) + coalesce(l_discount, 0) AS total "
        "FROM lineitem",

    "money_clean": """WITH t AS (SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS money_text FROM orders)
SELECT o_orderkey, money_text,
       cast(cast(nullif(trim(replace(replace(money_text, '$', ''), ',', '')), '') AS DECIMAL(18,4)) AS DOUBLE) AS amount
FROM t""",

    "coerce_number": """SELECT event_type, count(*) AS events,
  cast(sum(coalesce(TRY_CAST(nullif(trim(json_extract_string(props, '$.k')), '') AS BIGINT), 0)) AS BIGINT) AS k_total,
  cast(sum(CASE WHEN trim(event_type) IS NOT NULL AND trim(event_type) <> ''
                 AND TRY_CAST(trim(event_type) AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS text_coerced
FROM events GROUP BY event_type""",

    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",

    "json_items_explode": f"""SELECT p.p_brand AS "SKU", cast(sum(cast(l.l_quantity AS BIGINT)) AS BIGINT) AS "Units"
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_orderstatus IS DISTINCT FROM '{EXCLUDED_STATUS}' AND p.p_size < {UNMAPPED_MIN_SIZE}
GROUP BY p.p_brand""",

    "dict_lookup": "SELECT s_suppkey, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey",

    "reserve_clip": f"""SELECT cast(l_partkey AS VARCHAR) AS "SKU",
  sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0.0 END) AS "DTC",
  greatest(0, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0 END)
              - sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END)) AS "Reserve"
FROM lineitem WHERE cast(l_partkey AS VARCHAR) IN ({_CATALOG}) GROUP BY 1""",

    "outer_merge_measures": f"""WITH s AS (
  SELECT cast(l_partkey AS VARCHAR) AS sku, sum(l_quantity) AS units FROM lineitem
  WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY 1),
i AS (SELECT cast(l_partkey AS VARCHAR) AS sku, sum(l_quantity) AS inv, count(*) AS inb FROM lineitem
      WHERE l_returnflag = 'A' AND l_linestatus = 'O' GROUP BY 1),
m AS (SELECT coalesce(s.sku, i.sku) AS sku, s.units, i.inv, i.inb FROM s FULL JOIN i ON s.sku = i.sku),
t AS ({_CATALOG})
SELECT t.sku AS "SKU", cast(trunc(coalesce(m.units, 0)) AS BIGINT) AS "Units",
       cast(trunc(coalesce(m.inv, 0)) AS BIGINT) AS "Inventory", cast(coalesce(m.inb, 0) AS BIGINT) AS "Inbound"
FROM t LEFT JOIN m ON m.sku = t.sku""",

    "chained_template": f"""WITH li AS (SELECT cast(l_partkey AS VARCHAR) AS sku, l_returnflag, l_linestatus, l_quantity FROM lineitem),
t AS ({_CATALOG})
SELECT t.sku AS "SKU",
  coalesce(sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 0.0) AS "Inventory",
  coalesce(sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 0.0) AS "Units",
  coalesce(sum(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN l_quantity END), 0.0) AS "Inbound"
FROM t LEFT JOIN li ON li.sku = t.sku GROUP BY t.sku""",

    "union_channels":
        "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS kind "
        "FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, 'supplier' FROM supplier",

    "channel_bucket": """SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'TikTok Shopify' WHEN 'BUILDING' THEN 'Target'
  WHEN 'AUTOMOBILE' THEN 'Shopify' WHEN 'FURNITURE' THEN 'Shopify' ELSE 'Others' END AS bucket,
  count(*) AS customers, cast(sum(cast(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY 1""",

    "channel_dates": f"""WITH d AS (SELECT o_orderpriority AS ch, max(cast(o_orderdate AS DATE)) AS d FROM orders
           WHERE o_orderstatus IS DISTINCT FROM '{EXCLUDED_STATUS}' GROUP BY 1),
ch AS (SELECT * FROM (VALUES {_CH_VALUES}) t(channel_rank, channel))
SELECT ch.channel AS "Channel", ch.channel_rank, d.d AS data_date,
       coalesce(strftime(d.d, '%Y-%m-%d'), 'No data') AS status
FROM ch LEFT JOIN d ON d.ch = ch.channel""",

    "surrogate_ids": """SELECT o_orderkey,
  strftime(cast(o_orderdate AS DATE), '%Y%m%d') || '_' || replace(o_orderpriority, ' ', '_') || '_' || cast(o_custkey AS VARCHAR) AS id,
  replace(o_orderpriority, ' ', '_') || '_' || cast(o_custkey AS VARCHAR) AS sku_channel_id
FROM orders""",

    "clip_with_offenders":
        'SELECT c_mktsegment AS "Channel", cast(c_custkey AS VARCHAR) AS "SKU", greatest(c_acctbal, 0.0) AS c_acctbal '
        "FROM customer",

    "negative_offenders":
        'SELECT c_mktsegment AS "Channel", cast(c_custkey AS VARCHAR) AS "SKU", \'c_acctbal\' AS metric, '
        "c_acctbal AS value FROM customer WHERE c_acctbal < 0",

    "contract_violations": _violations("customer", [
        ("c_name", "required", "c_name IS NOT NULL"),
        ("c_mktsegment", "required", "c_mktsegment IS NOT NULL"),
        ("c_acctbal", "non_negative", "c_acctbal >= 0"),
        ("c_nationkey", "integral", "cast(c_nationkey AS DOUBLE) = floor(cast(c_nationkey AS DOUBLE))"),
    ]),

    "report_contract": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT) + _violations("report", [
        ("id", "required", "id IS NOT NULL"),
        ("sku_channel_id", "required", "sku_channel_id IS NOT NULL"),
        ("Date", "required", '"Date" IS NOT NULL'),
        ("SKU", "required", '"SKU" IS NOT NULL'),
        ("Channel", "required", '"Channel" IS NOT NULL'),
        ("Units", "integral", 'cast("Units" AS DOUBLE) = floor(cast("Units" AS DOUBLE))'),
    ]),

    "price_times_qty": f"""SELECT p_brand AS "SKU", sum(l_quantity) AS "Units",
  cast(sum(cast(p_retailprice AS DECIMAL(18,4)) * cast(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS "Revenue"
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE o_orderstatus IN ({", ".join(f"'{x}'" for x in ALLOWED_STATUSES)}) GROUP BY p_brand""",
})


_PREFIXES = [f"Orders_{c.replace(' ', '_')}_" for c in CHANNELS]


def _keyed_by_key(name: str, lines: str) -> str:
    return f"{name} AS (SELECT source_key, sum(q) AS qty, sum(r) AS rev FROM {lines} GROUP BY source_key)"


def _per_sku(name: str, keyed: str, mapping: str) -> str:
    return f"""{name}_e AS (SELECT unnest(targets) AS sku, qty, cast(cast(rev AS DOUBLE) / len(targets) AS DECIMAL(18,4)) AS rev
          FROM {keyed} JOIN {mapping} USING (source_key)),
{name} AS (SELECT sku, sum(qty) AS units, sum(rev) AS revenue FROM {name}_e GROUP BY sku)"""


_ALL_LINES = """lines_all AS (
  SELECT cast(l.l_partkey AS VARCHAR) AS source_key, l.l_quantity AS q, cast(l.l_extendedprice AS DECIMAL(18,2)) AS r
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_ONE_TO_ONE = f"m1 AS (SELECT cast(p_partkey AS VARCHAR) AS source_key, [p_brand] AS targets FROM part WHERE p_size < {UNMAPPED_MIN_SIZE})"

_RECON = _with(LINES, _ALL_LINES, MAPPING, _ONE_TO_ONE, _keyed_by_key("ko", "lines_all"), _per_sku("old", "ko", "m1"),
               _keyed_by_key("kn", "lines"), _per_sku("new", "kn", "m"),
               """recon AS (SELECT coalesce(o.sku, n.sku) AS sku, coalesce(o.units, 0) AS old_units,
                 coalesce(n.units, 0) AS new_units, coalesce(o.revenue, 0) AS old_rev, coalesce(n.revenue, 0) AS new_rev,
                 o.sku IS NOT NULL AS in_old, n.sku IS NOT NULL AS in_new
          FROM old o FULL JOIN new n ON o.sku = n.sku)""")

_INV = f"""pre AS (
  SELECT l_partkey, l_returnflag,
         sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END) AS u,
         sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END)
           - sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END) AS inv,
         count(*) AS inb, max(cast(l_shipdate AS DATE)) AS d
  FROM lineitem GROUP BY l_partkey, l_returnflag),
f AS (SELECT CASE l_returnflag {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in FLAG_CHANNEL.items())} ELSE 'Others' END AS channel,
             p_brand AS sku, sum(u) AS u, sum(inv) AS inv, sum(inb) AS inb, max(d) AS d
      FROM pre JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
ich AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(INVENTORY_CHANNELS))}) t(channel_rank, channel)),
skus AS (SELECT DISTINCT p_brand AS sku FROM part),
cd AS (SELECT channel, max(d) AS d FROM f GROUP BY channel),
body AS (
  SELECT g.channel, g.sku, coalesce(cd.d, DATE '{RUN_DATE}') AS d,
         cast(trunc(coalesce(f.u, 0)) AS BIGINT) AS u, cast(trunc(coalesce(f.inv, 0)) AS BIGINT) AS inv,
         cast(coalesce(f.inb, 0) AS BIGINT) AS inb
  FROM (SELECT ich.channel, skus.sku FROM ich CROSS JOIN skus) g
  LEFT JOIN f ON f.channel = g.channel AND f.sku = g.sku LEFT JOIN cd ON cd.channel = g.channel)"""

_SHOP_CHANNEL = " ".join(
    f"WHEN '{prio}' THEN '{SHOPIFY_BUCKETS.get(SHOPIFY_SOURCE_TO_CHANNEL.get(src, src), 'Others')}'"
    for prio, src in SOURCE_NAMES.items())

SQL.update({
    "latest_per_prefix": f"""WITH l AS (
  SELECT 'Orders_' || replace(o_orderpriority, ' ', '_') || '_' || strftime(cast(o_orderdate AS DATE), '%Y-%m-%d')
         || CASE WHEN o_orderstatus = 'F' THEN '.txt' ELSE '.csv' END AS name FROM orders),
p AS (SELECT name, regexp_extract(name, '^(Orders_.*_)(\\d{{4}}-\\d{{2}}-\\d{{2}})(\\.txt|\\.csv)$', 1) AS prefix,
             try_strptime(regexp_extract(name, '^(Orders_.*_)(\\d{{4}}-\\d{{2}}-\\d{{2}})(\\.txt|\\.csv)$', 2), '%Y-%m-%d')::DATE AS d,
             CASE regexp_extract(name, '^(Orders_.*_)(\\d{{4}}-\\d{{2}}-\\d{{2}})(\\.txt|\\.csv)$', 3) WHEN '.txt' THEN 0 ELSE 1 END AS er
      FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY (d = DATE '{RUN_DATE}') DESC, d DESC, er ASC, name DESC) AS rn
      FROM p WHERE d IS NOT NULL AND prefix IN ({", ".join(f"'{x}'" for x in _PREFIXES)}))
SELECT prefix, name, d AS report_date FROM r WHERE rn = 1""",

    "combine_history": """WITH s AS (
  SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS d, l_returnflag AS ch, cast(l_partkey AS VARCHAR) AS sku,
         sum(l_quantity) AS u, count(*) AS inv, max(l_linenumber) AS inb
  FROM lineitem GROUP BY 1, 2, 3)
SELECT strftime(d, '%Y%m%d') || '_' || ch || '_' || sku AS id, ch || '_' || sku AS sku_channel_id, d AS "Date",
       sku AS "SKU", ch AS "Channel", cast(trunc(u) AS BIGINT) AS "Units", cast(inv AS BIGINT) AS "Inventory",
       cast(inb AS BIGINT) AS "Inbound"
FROM s""",

    "run_summary": _with(*MAPPED, SALES, BUNDLES, GRID, REPORT) + f"""SELECT '{RUN_TIMESTAMP}' AS "timestamp",
  'sales' AS pipeline, max("Date") AS report_date, count(*) AS total_records,
  cast(sum("Units") AS BIGINT) AS total_units,
  cast(round_even(sum(cast("Revenue" AS DECIMAL(38,2))), 2) AS DOUBLE) AS total_revenue,
  '{", ".join(SOURCE_FILES)}' AS source_files
FROM report""",

    "reconcile_sources": _RECON + """SELECT sku AS "SKU", old_units AS "Old_Units", new_units AS "New_Units",
  round(new_units - old_units, 0) AS "Units_Diff", cast(old_rev AS DOUBLE) AS "Old_Rev", cast(new_rev AS DOUBLE) AS "New_Rev",
  cast(round_even(new_rev - old_rev, 2) AS DOUBLE) AS "Rev_Diff", in_old, in_new
FROM recon""",

    "reconcile_totals": _RECON + """SELECT sum(old_units) AS old_units, sum(new_units) AS new_units,
  cast(sum(old_rev) AS DOUBLE) AS old_revenue, cast(sum(new_rev) AS DOUBLE) AS new_revenue,
  cast(sum(CASE WHEN in_old AND NOT in_new THEN 1 ELSE 0 END) AS BIGINT) AS only_in_old,
  cast(sum(CASE WHEN in_new AND NOT in_old THEN 1 ELSE 0 END) AS BIGINT) AS only_in_new,
  cast(sum(CASE WHEN round(new_units - old_units, 0) <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS units_diff_count,
  sum(CASE WHEN round(new_units - old_units, 0) <> 0 THEN 1 ELSE 0 END) = 0 AS parsers_agree
FROM recon""",

    "parity_tolerance": _RECON + """SELECT sku AS "SKU", cast(round_even(new_rev - old_rev, 2) AS DOUBLE) AS "Rev_Diff",
  abs(cast(round_even(new_rev - old_rev, 2) AS DOUBLE)) <= greatest(0.0, 0.01 * abs(cast(old_rev AS DOUBLE)))
    AS within_tolerance
FROM recon""",

    "anomaly_trailing_7": """WITH d AS (
  SELECT event_type AS pipeline, cast(ts AS DATE) AS report_date, sum(cast(value AS DECIMAL(18,2))) AS total
  FROM events GROUP BY 1, 2),
w AS (SELECT *, count(total) OVER w7 AS n, sum(total) OVER w7 AS s FROM d
      WINDOW w7 AS (PARTITION BY pipeline ORDER BY report_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, CASE WHEN n > 0 THEN cast(s AS DOUBLE) / n END AS baseline FROM w)
SELECT pipeline, report_date, cast(total AS DOUBLE) AS total, baseline,
       coalesce(abs(cast(total AS DOUBLE) - baseline) > 0.5 * baseline, false) AS is_anomaly
FROM b""",

    "idempotency_guard": """SELECT DISTINCT o_orderpriority AS pipeline, cast(o_orderdate AS DATE) AS report_date
FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS (
  SELECT 1 FROM orders f WHERE f.o_orderstatus = 'F' AND f.o_orderpriority = o.o_orderpriority
    AND cast(f.o_orderdate AS DATE) = cast(o.o_orderdate AS DATE))""",

    "sku_trend": """WITH m AS (
  SELECT p_brand AS sku, cast(date_trunc('month', l_shipdate) AS DATE) AS d, sum(l_quantity) AS units
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
SELECT sku AS "SKU", d AS "Date", units AS "Units", lag(units) OVER (PARTITION BY sku ORDER BY d) AS "prev_Units",
       units - lag(units) OVER (PARTITION BY sku ORDER BY d) AS "delta_Units"
FROM m""",

    "rollup_totals": f"""SELECT p_brand AS "SKU", o_orderpriority AS "Channel", sum(l_quantity) AS units,
  cast(sum(cast(l_extendedprice AS DECIMAL(18,2)) * (1 - cast(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS net_sales,
  GROUPING(p_brand, o_orderpriority) > 0 AS is_total
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
WHERE l_shipdate >= TIMESTAMP '{ROLLUP_FROM}' AND l_shipdate < TIMESTAMP '{ROLLUP_TO}'
GROUP BY GROUPING SETS ((p_brand, o_orderpriority), ())""",

    "net_of_discounts": _with(f"""li AS (
  SELECT cast(l.l_partkey AS VARCHAR) AS source_key, CASE o.o_orderpriority {_SHOP_CHANNEL} ELSE 'Others' END AS channel,
         cast(cast(l.l_quantity AS BIGINT) AS DOUBLE) AS q,
         round_even(cast(cast(l.l_quantity AS BIGINT) AS DECIMAL(38,4)) * cast(cast(p.p_retailprice AS DECIMAL(18,2)) AS DECIMAL(38,4))
               - cast(l.l_extendedprice AS DECIMAL(18,2)) * cast(l.l_discount AS DECIMAL(18,2)), 2) AS net
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey)""",
        """kept AS (SELECT * FROM li WHERE NOT (q = 0 AND net = 0) AND (cast(net AS DOUBLE) > 0 OR q > 0))""",
        """keyed AS (SELECT source_key, channel, sum(q) AS qty, sum(cast(net AS DECIMAL(18,4))) AS rev FROM kept
           GROUP BY source_key, channel)""", MAPPING, JOINED, SALES, BUNDLES)
    + """SELECT channel AS "Channel", sku AS "SKU", units AS "Units", cast(revenue AS DOUBLE) AS "Revenue" FROM sales
UNION ALL SELECT channel, 'Bundles', units, cast(revenue AS DOUBLE) FROM bund""",

    "landed_tiktok_fbt": _with(f"""li AS (
  SELECT cast(l.l_partkey AS VARCHAR) AS source_key, cast(cast(l.l_quantity AS BIGINT) AS DOUBLE) AS q,
         cast(cast(o.o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS r
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE o.o_orderstatus IS DISTINCT FROM '{EXCLUDED_STATUS}' AND o.o_orderpriority IN ({", ".join(f"'{p}'" for p in FBT_PRIORITIES)}))""",
        """keyed AS (SELECT source_key, 'all' AS channel, sum(q) AS qty, sum(r) AS rev FROM li GROUP BY source_key)""",
        MAPPING, JOINED, SALES, BUNDLES)
    + """SELECT sku AS "SKU", units AS "Units", cast(revenue AS DOUBLE) AS "Revenue" FROM sales
UNION ALL SELECT 'Bundles', units, cast(revenue AS DOUBLE) FROM bund""",

    "inventory_report_zero_filled": _with(_INV) + f"""SELECT
  strftime(DATE '{RUN_DATE}', '%Y%m%d') || '_' || replace(channel, ' ', '_') || '_' || sku AS id,
  replace(channel, ' ', '_') || '_' || sku AS sku_channel_id, d AS "Date", sku AS "SKU", channel AS "Channel",
  greatest(u, 0) AS "Units", greatest(inv, 0) AS "Inventory", greatest(inb, 0) AS "Inbound"
FROM body""",

    "inventory_offenders": _with(_INV) + """SELECT channel AS "Channel", sku AS "SKU", metric, value FROM (
  SELECT channel, sku, 'Units' AS metric, cast(u AS DOUBLE) AS value FROM body
  UNION ALL SELECT channel, sku, 'Inventory', cast(inv AS DOUBLE) FROM body
  UNION ALL SELECT channel, sku, 'Inbound', cast(inb AS DOUBLE) FROM body) x WHERE value < 0""",

    "source_metrics": _with(*MAPPED, SALES) + """, ra AS (SELECT channel, sum(nrows) AS n FROM keyed GROUP BY channel),
rf AS (SELECT channel, count(*) AS c FROM sales GROUP BY channel)
SELECT ra.channel AS "Channel", cast(ra.n AS BIGINT) AS rows_analyzed, coalesce(rf.c, 0) AS rows_found
FROM ra LEFT JOIN rf ON rf.channel = ra.channel""",
})

_C7_CHANNEL = """WHEN '1-URGENT' THEN 'Shopify' WHEN '2-HIGH' THEN 'Shopify' WHEN '3-MEDIUM' THEN 'TikTok Shopify'
  WHEN '4-NOT SPECIFIED' THEN 'Target'"""

SQL["shopify_orders_paid"] = _with(f"""li AS (
  SELECT cast(l.l_partkey AS VARCHAR) AS source_key, CASE o.o_orderpriority {_C7_CHANNEL} ELSE 'Others' END AS channel,
         l.l_quantity AS q, cast(p.p_retailprice AS DECIMAL(18,4)) * cast(l.l_quantity AS DECIMAL(18,4)) AS r
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
  WHERE o.o_orderstatus = '{PAID_STATUS}')""",
    """keyed AS (SELECT source_key, channel, sum(q) AS qty, sum(r) AS rev FROM li GROUP BY source_key, channel)""",
    MAPPING, JOINED, SALES, BUNDLES) + """SELECT channel AS "Channel", sku AS "SKU", units AS "Units",
  cast(revenue AS DOUBLE) AS "Revenue" FROM sales
UNION ALL SELECT channel, 'Bundles', units, cast(revenue AS DOUBLE) FROM bund"""

SQL["payload_json"] = _with(*MAPPED, SALES, BUNDLES, GRID, REPORT, f"""placed AS (
  SELECT *, cast(cast('0x' || substr(md5(id), 1, 7) AS BIGINT) % {PAYLOAD_CHUNKS} AS INTEGER) AS chunk FROM report)""") + f"""
SELECT 'sales' AS "reportType", chunk, {PAYLOAD_CHUNKS} AS chunks,
  cast(row_number() OVER (PARTITION BY chunk ORDER BY id) - 1 AS INTEGER) AS place, id, sku_channel_id,
  strftime("Date", '%Y-%m-%d') AS "Date", "SKU", "Channel", "Units", "Revenue" FROM placed
UNION ALL SELECT 'sales', -1, NULL, NULL, NULL, NULL, strftime(max("Date"), '%Y-%m-%d'), NULL, "Channel", NULL, NULL
FROM report GROUP BY "Channel" """
