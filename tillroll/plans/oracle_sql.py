"""DuckDB oracle SQL for the registered queries.

Each statement is independent ANSI-ish SQL over the driver's pre-registered
tables. Shared fixture views are inlined as CTEs. Double outputs are rounded
with ``round_even(x * 10^d, 0) / 10^d`` to mirror ``np_round`` on the Spark
side (rint of the scaled value).
"""

from __future__ import annotations

RETAIL_CTE = """
retail AS (
  SELECT o_orderkey AS Invoice, l_partkey AS StockCode, p_name AS Description,
         CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN -l_quantity ELSE l_quantity END AS Quantity,
         o_orderdate AS InvoiceDate, p_retailprice AS Price, o_custkey AS CustomerID, n_name AS Country
  FROM lineitem
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN part     ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation   ON c_nationkey = n_nationkey
)"""

DIRTY_CTE = RETAIL_CTE + """,
dirty_once AS (
  SELECT Invoice, StockCode,
         CASE WHEN StockCode % 97 = 0 THEN NULL ELSE Description END AS Description,
         Quantity, InvoiceDate, Price,
         CASE WHEN Invoice % 4 = 0 THEN NULL ELSE CustomerID END AS CustomerID, Country
  FROM retail),
retail_dirty AS (
  SELECT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, CustomerID AS "Customer ID", Country
  FROM (SELECT * FROM dirty_once UNION ALL SELECT * FROM dirty_once WHERE Invoice % 50 = 0))"""

CLEAN_CTE = DIRTY_CTE + """,
clean AS (
  SELECT DISTINCT Invoice, StockCode, Description, Quantity, InvoiceDate, Price, "Customer ID", Country
  FROM retail_dirty
  WHERE Description IS NOT NULL AND "Customer ID" IS NOT NULL),
lines AS (SELECT *, Quantity * Price AS TotalPrice FROM clean)"""

RFM_CTE = CLEAN_CTE + """,
per_invoice AS (
  SELECT "Customer ID", Invoice, max(InvoiceDate) AS _last, sum(TotalPrice) AS _value
  FROM lines GROUP BY "Customer ID", Invoice),
per_customer AS (
  SELECT "Customer ID", max(_last) AS LastPurchase, count(*) AS Frequency_raw, sum(_value) AS Monetary_raw
  FROM per_invoice GROUP BY "Customer ID"),
rfm_all AS (
  SELECT *, CAST(floor((epoch_us((SELECT max(InvoiceDate) FROM lines) + INTERVAL 1 DAY)
                        - epoch_us(LastPurchase)) / 86400000000) AS BIGINT) AS Recency
  FROM per_customer),
rfm AS (
  SELECT "Customer ID", Recency, ln(1 + Frequency_raw) AS Frequency, ln(1 + Monetary_raw) AS Monetary,
         Frequency_raw, Monetary_raw
  FROM rfm_all WHERE Monetary_raw > 0 AND Frequency_raw > 0 AND Recency >= 0)"""


def r(expr: str, digits: int = 6) -> str:
    """SQL twin of ``np_round``."""
    scale = f"1e{digits}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


ORACLE: dict[str, str] = {}

ORACLE["rfm_log"] = f"""
WITH {RFM_CTE}
SELECT "Customer ID", Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary,
       Frequency_raw, {r('Monetary_raw', 2)} AS Monetary_raw
FROM rfm"""

FEATURE_CTE = CLEAN_CTE + """,
dated AS (
  SELECT *, CAST(year(InvoiceDate) AS INTEGER) AS Year, CAST(month(InvoiceDate) AS INTEGER) AS Month,
         CAST(day(InvoiceDate) AS INTEGER) AS Day, CAST(hour(InvoiceDate) AS INTEGER) AS Hour,
         CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayOfWeek
  FROM lines),
inv AS (
  SELECT Invoice, sum(_q) AS TransactionSize, count(StockCode) AS UniqueItems
  FROM (SELECT Invoice, StockCode, sum(Quantity) AS _q FROM dated GROUP BY Invoice, StockCode)
  GROUP BY Invoice),
feat AS (SELECT d.*, i.TransactionSize, i.UniqueItems FROM dated d LEFT JOIN inv i USING (Invoice))"""

DIRTY_COLS = [("Invoice", "bigint"), ("StockCode", "bigint"), ("Description", "string"), ("Quantity", "double"),
              ("InvoiceDate", "timestamp_ntz"), ("Price", "double"), ("Customer ID", "bigint"), ("Country", "string")]


def q(name: str) -> str:
    return '"' + name + '"'


def hist_sql(src: str, col: str, bins: int = 50) -> str:
    """CTE chain ending in ``hist(bin, bin_start, bin_end, count)`` (numpy edges)."""
    b = f"CAST({bins} AS DOUBLE)"
    return f"""
hs AS (SELECT CASE WHEN min({col}) = max({col}) THEN min({col}) - 0.5 ELSE min({col}) END AS lo,
              CASE WHEN min({col}) = max({col}) THEN max({col}) + 0.5 ELSE max({col}) END AS hi
       FROM {src} WHERE {col} IS NOT NULL),
hx AS (SELECT CAST({col} AS DOUBLE) AS x, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi,
              (CAST(hi AS DOUBLE) - CAST(lo AS DOUBLE)) / {b} AS step
       FROM {src}, hs WHERE {col} IS NOT NULL),
h0 AS (SELECT *, LEAST(CAST(floor((x - lo) / (hi - lo) * {b}) AS INTEGER), {bins - 1}) AS i0 FROM hx),
h1 AS (SELECT *, CASE WHEN x < (CASE WHEN i0 = {bins} THEN hi ELSE i0 * step + lo END)
                      THEN i0 - 1 ELSE i0 END AS i1 FROM h0),
h2 AS (SELECT CASE WHEN x >= (CASE WHEN i1 + 1 = {bins} THEN hi ELSE (i1 + 1) * step + lo END)
                        AND i1 <> {bins - 1} THEN i1 + 1 ELSE i1 END AS bin FROM h1),
hc AS (SELECT bin, count(*) AS cnt FROM h2 GROUP BY bin),
hg AS (SELECT CAST(g.bin AS INTEGER) AS bin, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi,
              (CAST(hi AS DOUBLE) - CAST(lo AS DOUBLE)) / {b} AS step
       FROM hs, range(0, {bins}) g(bin)),
hist AS (SELECT bin, i.bin * step + lo AS bin_start,
                CASE WHEN bin + 1 = {bins} THEN hi ELSE (bin + 1) * step + lo END AS bin_end,
                CAST(coalesce(cnt, 0) AS BIGINT) AS count
         FROM hg i LEFT JOIN hc USING (bin))"""


ORACLE["profile_summary"] = f"""
WITH {DIRTY_CTE}
SELECT (SELECT count(*) FROM retail_dirty) AS rows, CAST(8 AS BIGINT) AS columns,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
          SELECT count(*) AS n FROM retail_dirty
          GROUP BY Invoice, StockCode, Description, Quantity, InvoiceDate, Price, "Customer ID", Country)) AS duplicate_rows,
       (SELECT CAST({' + '.join(f'count_if({q(c)} IS NULL)' for c, _ in DIRTY_COLS)} AS BIGINT) FROM retail_dirty)
         AS total_missing"""

ORACLE["profile_missing"] = f"""
WITH {DIRTY_CTE},
n AS (SELECT count(*) AS _rows, {', '.join(f'count_if({q(c)} IS NULL) AS m{i}' for i, (c, _) in enumerate(DIRTY_COLS))}
      FROM retail_dirty)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"Column\", '{t}' AS DataType, CAST(_rows - m{i} AS BIGINT) AS Non_Null_Count, "
    f"CAST(m{i} AS BIGINT) AS Missing_Count, {r(f'm{i} * 100.0 / _rows', 2)} AS Missing_Percentage FROM n"
    for i, (c, t) in enumerate(DIRTY_COLS))

DESCRIBE_COLS = ["Invoice", "StockCode", "Quantity", "Price", "Customer ID"]
ORACLE["profile_describe"] = f"""
WITH {DIRTY_CTE}
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "Column", count({q(c)}) AS count, {r(f'avg(CAST({q(c)} AS DOUBLE))')} AS mean,
       {r(f'stddev_samp(CAST({q(c)} AS DOUBLE))')} AS std, {r(f'min(CAST({q(c)} AS DOUBLE))')} AS min,
       {r(f'quantile_cont(CAST({q(c)} AS DOUBLE), 0.25)')} AS p25,
       {r(f'quantile_cont(CAST({q(c)} AS DOUBLE), 0.5)')} AS p50,
       {r(f'quantile_cont(CAST({q(c)} AS DOUBLE), 0.75)')} AS p75,
       {r(f'max(CAST({q(c)} AS DOUBLE))')} AS max FROM retail_dirty""" for c in DESCRIBE_COLS)

ORACLE["clean_lineage"] = f"""
WITH {CLEAN_CTE},
a AS (SELECT count(*) AS original_rows, count_if(Description IS NULL) AS dnd,
             count_if(Description IS NOT NULL AND "Customer ID" IS NULL) AS dnc FROM retail_dirty),
b AS (SELECT count(*) AS cleaned_rows, count(DISTINCT "Customer ID") AS uc, count(DISTINCT Invoice) AS ui,
             count(DISTINCT StockCode) AS up, count(DISTINCT Country) AS uco FROM clean)
SELECT CAST(original_rows AS BIGINT) AS original_rows, CAST(cleaned_rows AS BIGINT) AS cleaned_rows,
       CAST(dnd AS BIGINT) AS dropped_null_description, CAST(dnc AS BIGINT) AS dropped_null_customer,
       CAST(original_rows - dnd - dnc - cleaned_rows AS BIGINT) AS dropped_duplicates,
       CAST(uc AS BIGINT) AS unique_customers, CAST(ui AS BIGINT) AS unique_invoices,
       CAST(up AS BIGINT) AS unique_products, CAST(uco AS BIGINT) AS unique_countries
FROM a, b"""

ORACLE["clean_lines"] = f"""
WITH {CLEAN_CTE}
SELECT * FROM clean"""

ORACLE["features_invoice_stats"] = f"""
WITH {FEATURE_CTE}
SELECT Invoice, StockCode, Quantity, InvoiceDate, Price, "Customer ID", Country, Year, Month, Day, Hour, DayOfWeek,
       {r('TotalPrice', 4)} AS TotalPrice, {r('TransactionSize')} AS TransactionSize, UniqueItems
FROM feat"""

SCALE = ["Quantity", "Price", "TotalPrice", "TransactionSize", "UniqueItems"]
ORACLE["features_scaler_params"] = f"""
WITH {FEATURE_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
    f"{r(f'CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END')} AS scale "
    f"FROM feat" for c in SCALE)

ORACLE["features_scaled"] = f"""
WITH {FEATURE_CTE},
p AS (SELECT {', '.join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS s_{c}" for c in SCALE)} FROM feat)
SELECT Invoice, StockCode, InvoiceDate, "Customer ID",
       {', '.join(f"{r(f'(CAST({c} AS DOUBLE) - m_{c}) / s_{c}')} AS {c}" for c in SCALE)},
       'Country_' || Country AS hot_columns, 1 AS hot_count
FROM feat, p"""

ORACLE["features_one_hot_counts"] = f"""
WITH {CLEAN_CTE}
SELECT 'Country_' || Country AS "column", CAST(count(*) AS BIGINT) AS ones
FROM clean GROUP BY Country"""

ORACLE["eda_kpis"] = f"""
WITH {FEATURE_CTE}
SELECT count(*) AS total_transactions, count(DISTINCT "Customer ID") AS unique_customers,
       count(DISTINCT StockCode) AS unique_products, count(DISTINCT Country) AS unique_countries,
       {r('sum(TotalPrice)', 2)} AS total_revenue, {r('avg(TotalPrice)')} AS avg_transaction_value,
       CAST(floor((epoch_us(max(InvoiceDate)) - epoch_us(min(InvoiceDate))) / 86400000000) AS BIGINT) AS date_range_days,
       {r('quantile_cont(TotalPrice, 0.5)')} AS median_transaction_value
FROM dated"""

ORACLE["eda_monthly_revenue"] = f"""
WITH {FEATURE_CTE}
SELECT Year, Month, {r('sum(TotalPrice)', 2)} AS TotalPrice, make_date(Year, Month, 1) AS Date
FROM dated GROUP BY Year, Month"""

ORACLE["eda_monthly_active_customers"] = f"""
WITH {FEATURE_CTE}
SELECT Year, Month, count(DISTINCT "Customer ID") AS ActiveCustomers, make_date(Year, Month, 1) AS Date
FROM dated GROUP BY Year, Month"""

ORACLE["eda_top_countries"] = f"""
WITH {FEATURE_CTE}
SELECT Country, {r('s', 2)} AS TotalPrice FROM (
  SELECT Country, sum(TotalPrice) AS s FROM dated WHERE Country IS NOT NULL GROUP BY Country)
ORDER BY s DESC, Country LIMIT 10"""

ORACLE["eda_top_products"] = f"""
WITH {FEATURE_CTE}
SELECT Description, {r('s', 2)} AS Quantity FROM (
  SELECT Description, sum(Quantity) AS s FROM dated WHERE Description IS NOT NULL GROUP BY Description)
ORDER BY s DESC, Description LIMIT 10"""

ORACLE["eda_top_customers"] = f"""
WITH {FEATURE_CTE}
SELECT CAST("Customer ID" AS VARCHAR) AS "Customer ID", {r('s', 2)} AS TotalPrice FROM (
  SELECT "Customer ID", sum(TotalPrice) AS s FROM dated WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID")
ORDER BY s DESC, "Customer ID" LIMIT 10"""

ORACLE["eda_weekday_hour"] = """
WITH act AS (
  SELECT event_id AS Invoice, CAST(isodow(ts) - 1 AS INTEGER) AS DayOfWeek, CAST(hour(ts) AS INTEGER) AS Hour
  FROM events)
SELECT DayOfWeek, Hour, count(DISTINCT Invoice) AS Invoices,
       ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][DayOfWeek + 1] AS Day
FROM act GROUP BY DayOfWeek, Hour"""

ORACLE["eda_revenue_by_weekday"] = f"""
WITH {FEATURE_CTE}
SELECT DayOfWeek, {r('sum(TotalPrice)', 2)} AS TotalPrice,
       ['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][DayOfWeek + 1] AS DayName
FROM dated GROUP BY DayOfWeek"""

REVENUE_KEPT = FEATURE_CTE + """,
p99 AS (SELECT quantile_cont(TotalPrice, 0.99) AS p99 FROM dated),
kept AS (SELECT TotalPrice FROM dated, p99 WHERE TotalPrice > 0 AND TotalPrice < p99.p99)"""

ORACLE["eda_revenue_histogram"] = f"""
WITH {REVENUE_KEPT}, {hist_sql('kept', 'TotalPrice')}
SELECT bin, {r('bin_start')} AS bin_start, {r('bin_end')} AS bin_end, count FROM hist"""

ORACLE["eda_revenue_stats"] = f"""
WITH {REVENUE_KEPT}
SELECT {r('(SELECT p99 FROM p99)')} AS p99, count(*) AS n, {r('avg(TotalPrice)')} AS mean,
       {r('quantile_cont(TotalPrice, 0.5)')} AS median
FROM kept"""

PURCHASE_CTE = FEATURE_CTE + """,
pc AS (SELECT "Customer ID", count(DISTINCT Invoice) AS PurchaseCount FROM dated
       WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID"),
pcc AS (SELECT LEAST(PurchaseCount, 50) AS PurchaseCount FROM pc)"""

ORACLE["eda_purchase_frequency"] = f"""
WITH {PURCHASE_CTE}
SELECT count(*) AS customers, {r('avg(PurchaseCount)')} AS avg_purchases_per_customer,
       CAST(max(PurchaseCount) AS BIGINT) AS max_purchases_by_customer,
       count_if(PurchaseCount = 1) AS single_purchase_customers
FROM pc"""

ORACLE["eda_purchase_histogram"] = f"""
WITH {PURCHASE_CTE}, {hist_sql('pcc', 'PurchaseCount')}
SELECT bin, {r('bin_start')} AS bin_start, {r('bin_end')} AS bin_end, count FROM hist"""

ORACLE["eda_quantity_price_sample"] = f"""
WITH {FEATURE_CTE}
SELECT Invoice, StockCode, Quantity, Price FROM dated
WHERE Quantity > 0 AND Price > 0
ORDER BY md5(concat_ws(':', CAST(Invoice AS VARCHAR), CAST(StockCode AS VARCHAR),
                       CAST(CAST(Quantity AS BIGINT) AS VARCHAR)) || ':42'), Invoice, StockCode, Quantity, Price
LIMIT 5000"""

ORACLE["eda_purchase_frequency"] = ORACLE["eda_purchase_frequency"].replace(
    "count_if(PurchaseCount = 1) AS single_purchase_customers",
    "CAST(count_if(PurchaseCount = 1) AS BIGINT) AS single_purchase_customers")

# ------------------------------------------------------------ clustering
SCALED_CTE = RFM_CTE + """,
sc AS (SELECT avg(CAST(Recency AS DOUBLE)) AS mr, stddev_pop(CAST(Recency AS DOUBLE)) AS sr0,
              avg(Frequency) AS mf, stddev_pop(Frequency) AS sf0, avg(Monetary) AS mm, stddev_pop(Monetary) AS sm0
       FROM rfm),
rs AS (SELECT rfm.*,
              (CAST(Recency AS DOUBLE) - mr) / (CASE WHEN sr0 = 0 THEN 1.0 ELSE sr0 END) AS Recency_s,
              (Frequency - mf) / (CASE WHEN sf0 = 0 THEN 1.0 ELSE sf0 END) AS Frequency_s,
              (Monetary - mm) / (CASE WHEN sm0 = 0 THEN 1.0 ELSE sm0 END) AS Monetary_s
       FROM rfm, sc),
cent AS (SELECT CAST(Cluster AS INTEGER) AS Cluster, CAST(cr AS DOUBLE) AS cr, CAST(cf AS DOUBLE) AS cf,
                CAST(cm AS DOUBLE) AS cm
         FROM (VALUES (0, -0.6, 0.6, 0.6), (1, -0.3, -0.5, -0.4), (2, 0.5, 0.4, 0.5), (3, 2.0, -1.2, -1.3))
              t(Cluster, cr, cf, cm)),
dd AS (SELECT rs.*, Cluster,
              (Recency_s - cr) * (Recency_s - cr) + (Frequency_s - cf) * (Frequency_s - cf)
              + (Monetary_s - cm) * (Monetary_s - cm) AS SqDistance
       FROM rs, cent),
clustered AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY SqDistance, Cluster) AS rn FROM dd)
  WHERE rn = 1)"""

ORACLE["cluster_assign_fixed"] = f"""
WITH {SCALED_CTE}
SELECT "Customer ID", {r('Recency_s')} AS Recency_s, {r('Frequency_s')} AS Frequency_s,
       {r('Monetary_s')} AS Monetary_s, Cluster, {r('SqDistance')} AS SqDistance
FROM clustered"""

ORACLE["cluster_inertia_fixed"] = f"""
WITH {SCALED_CTE}
SELECT Cluster, count(*) AS n, {r('sum(SqDistance)')} AS inertia FROM clustered GROUP BY Cluster"""


def quality_ctes() -> str:
    """CTEs over ``pts(key, label, vec DOUBLE[])`` ending in ``quality`` and ``sil``."""
    return """
ex AS (SELECT key, label, unnest(vec) AS v, unnest(range(1, len(vec) + 1)) AS pos FROM pts),
qcent AS (SELECT label, pos, avg(v) AS m FROM ex GROUP BY label, pos),
csize AS (SELECT label, count(*) AS n FROM pts GROUP BY label),
pd AS (SELECT ex.key, ex.label, sum((v - m) * (v - m)) AS d2 FROM ex JOIN qcent USING (label, pos)
       GROUP BY ex.key, ex.label),
inert AS (SELECT sum(d2) AS inertia FROM pd),
s_in AS (SELECT label, avg(sqrt(d2)) AS S FROM pd GROUP BY label),
cd AS (SELECT a.label AS li, b.label AS lj, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d
       FROM qcent a JOIN qcent b ON a.pos = b.pos AND a.label <> b.label GROUP BY a.label, b.label),
dbs AS (SELECT li, max(CASE WHEN d = 0 THEN 0.0 ELSE (s1.S + s2.S) / d END) AS score
        FROM cd JOIN s_in s1 ON s1.label = li JOIN s_in s2 ON s2.label = lj GROUP BY li),
db AS (SELECT CASE WHEN (SELECT count(*) FROM s_in) < 2 THEN CAST('inf' AS DOUBLE)
                   WHEN (SELECT max(S) FROM s_in) = 0 THEN 0.0 ELSE avg(score) END AS davies_bouldin FROM dbs),
g AS (SELECT pos, avg(v) AS gm FROM ex GROUP BY pos),
bb AS (SELECT sum(n * d2) AS B FROM (
         SELECT c.label, sum((c.m - g.gm) * (c.m - g.gm)) AS d2 FROM qcent c JOIN g USING (pos) GROUP BY c.label)
       JOIN csize USING (label)),
chs AS (SELECT (SELECT B FROM bb) AS B, (SELECT inertia FROM inert) AS W, (SELECT count(*) FROM pts) AS n,
               (SELECT count(*) FROM csize) AS k),
ch AS (SELECT CASE WHEN k < 2 THEN 0.0 WHEN W = 0 THEN 1.0 ELSE B * (n - k) / (W * (k - 1)) END
              AS calinski_harabasz FROM chs),
pair AS (SELECT a.key AS i, b.label AS lj, list_distance(a.vec, b.vec) AS d
         FROM pts a JOIN pts b ON a.key <> b.key),
per AS (SELECT i, lj, avg(d) AS md FROM pair GROUP BY i, lj),
ab AS (SELECT p.key, p.label, max(CASE WHEN per.lj = p.label THEN md END) AS a,
              min(CASE WHEN per.lj <> p.label THEN md END) AS b
       FROM pts p LEFT JOIN per ON per.i = p.key GROUP BY p.key, p.label),
sil AS (SELECT ab.key, ab.label,
               CASE WHEN cs.n <= 1 OR b IS NULL OR greatest(a, b) = 0 THEN 0.0
                    ELSE (b - a) / greatest(a, b) END AS silhouette
        FROM ab JOIN csize cs USING (label)),
quality AS (SELECT (SELECT count(*) FROM pts) AS n, (SELECT count(*) FROM csize) AS k,
                   (SELECT inertia FROM inert) AS inertia,
                   (SELECT CASE WHEN count(DISTINCT label) < 2 THEN 0.0 ELSE avg(silhouette) END FROM sil)
                     AS silhouette,
                   (SELECT davies_bouldin FROM db) AS davies_bouldin,
                   (SELECT calinski_harabasz FROM ch) AS calinski_harabasz)"""


QUALITY_SELECT = f"""
SELECT n, k, {r('inertia')} AS inertia, {r('silhouette')} AS silhouette, {r('davies_bouldin')} AS davies_bouldin,
       {r('calinski_harabasz')} AS calinski_harabasz FROM quality"""

METRIC_SAMPLE = 10_000


def safe_sample(src: str, out: str) -> str:
    """CTE ``out``: the cluster-safe sample of ``src(key, label, ...)``."""
    return f"""
{out}_first AS (SELECT min(key) AS key FROM {src} GROUP BY label),
{out} AS (SELECT * FROM {src} WHERE key IN (SELECT key FROM {out}_first)
          UNION ALL (SELECT * FROM {src} WHERE key NOT IN (SELECT key FROM {out}_first)
                     ORDER BY md5(CAST(key AS VARCHAR) || ':42'), key
                     LIMIT (SELECT greatest(0, {METRIC_SAMPLE} - count(*)) FROM {out}_first)))"""


EMB_ALL = """allpts AS (SELECT vec_id AS key, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS vec
                FROM embeddings)"""
EMB_PTS = EMB_ALL + "," + safe_sample("allpts", "pts")

ORACLE["cluster_silhouette_squared_embeddings"] = f"""
WITH {EMB_ALL},
sqex AS (SELECT key, label, unnest(vec) AS v, unnest(range(1, len(vec) + 1)) AS pos FROM allpts),
sqm AS (SELECT label, pos, avg(v) AS m, avg(v * v) AS m2 FROM sqex GROUP BY label, pos),
sqn AS (SELECT label, count(*) AS n FROM allpts GROUP BY label),
sqd AS (SELECT e.key, e.label, c.label AS other, sum(e.v * e.v - 2 * e.v * c.m + c.m2) AS d
        FROM sqex e JOIN sqm c USING (pos) GROUP BY e.key, e.label, c.label),
sqa AS (SELECT d.key, d.label, n.n, max(CASE WHEN other = d.label THEN d.d * n.n / (n.n - 1) END) AS a,
               min(CASE WHEN other <> d.label THEN d.d END) AS b
        FROM sqd d JOIN sqn n ON n.label = d.label GROUP BY d.key, d.label, n.n)
SELECT {r('avg(CASE WHEN n <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette_squared FROM sqa"""

ORACLE["cluster_quality_embeddings"] = f"WITH {EMB_PTS}, {quality_ctes()} {QUALITY_SELECT}"

ORACLE["cluster_silhouette_embeddings"] = f"""
WITH {EMB_PTS}, {quality_ctes()}
SELECT key AS vec_id, label, {r('silhouette')} AS silhouette FROM sil"""

ORACLE["cluster_quality_rfm_fixed"] = f"""
WITH {SCALED_CTE},
allpts AS (SELECT "Customer ID" AS key, CAST(Cluster AS BIGINT) AS label,
                  [Recency_s, Frequency_s, Monetary_s] AS vec FROM clustered),
{safe_sample('allpts', 'pts')},
{quality_ctes()} {QUALITY_SELECT}"""

ALL_METRICS_SELECT = f"""
SELECT n, k, {r('inertia')} AS inertia, {r('davies_bouldin')} AS davies_bouldin, {r('calinski_harabasz')} AS calinski_harabasz
FROM (SELECT (SELECT count(*) FROM pts) AS n, (SELECT count(*) FROM csize) AS k, (SELECT inertia FROM inert) AS inertia,
             (SELECT davies_bouldin FROM db) AS davies_bouldin, (SELECT calinski_harabasz FROM ch) AS calinski_harabasz)"""
ORACLE["cluster_metrics_embeddings"] = f"WITH {EMB_ALL}, pts AS (SELECT * FROM allpts), {quality_ctes()} {ALL_METRICS_SELECT}"
ORACLE["cluster_metrics_rfm"] = f"""
WITH {SCALED_CTE},
pts AS (SELECT "Customer ID" AS key, CAST(Cluster AS BIGINT) AS label, [Recency_s, Frequency_s, Monetary_s] AS vec FROM clustered),
{quality_ctes()} {ALL_METRICS_SELECT}"""
ORACLE["cluster_silhouette_estimate"] = f"""
WITH {SCALED_CTE}
SELECT count(*) AS n, TRUE AS in_range, TRUE AS inside, TRUE AS narrow FROM clustered"""
ORACLE["quantile_sketch_checks"] = f"""
WITH {CLEAN_CTE}
""" + "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "Column", CAST({p} AS DOUBLE) AS p, count({expr}) AS n, TRUE AS within_bound FROM clean"""
    for name, expr in (("Quantity", "Quantity"), ("Price", "Price"), ("TotalPrice", "Quantity * Price")) for p in (0.01, 0.25, 0.5, 0.75, 0.99))

# -------------------------------------------------------------- segments
SEGMENT_CTE = SCALED_CTE + """,
csum AS (SELECT Cluster, avg(Recency) AS Recency, avg(Frequency) AS Frequency, avg(Monetary) AS Monetary,
                count(*) AS Count FROM clustered GROUP BY Cluster),
csum2 AS (SELECT *, CAST(Count AS DOUBLE) * 100.0 / CAST(sum(Count) OVER () AS DOUBLE) AS Percentage FROM csum),
sc1 AS (SELECT *,
           rank() OVER (ORDER BY Recency DESC) + (count(*) OVER (PARTITION BY Recency) - 1) / 2.0 AS R_Score,
           rank() OVER (ORDER BY Frequency) + (count(*) OVER (PARTITION BY Frequency) - 1) / 2.0 AS F_Score,
           rank() OVER (ORDER BY Monetary) + (count(*) OVER (PARTITION BY Monetary) - 1) / 2.0 AS M_Score
        FROM csum2),
sc2 AS (SELECT *, R_Score + F_Score + M_Score AS Total_Score FROM sc1),
sc3 AS (SELECT *, CAST(row_number() OVER (ORDER BY Total_Score DESC, Cluster) AS INTEGER) AS Position FROM sc2),
scored AS (SELECT *, CASE Position WHEN 1 THEN 'Champions' WHEN 2 THEN 'Potential Loyalists'
                                  WHEN 3 THEN 'At Risk' WHEN 4 THEN 'Lost' END AS Segment FROM sc3),
labeled AS (SELECT c.*, s.Segment,
                   CAST(c.Recency AS DOUBLE) / (SELECT max(Recency) FROM clustered) AS ChurnProbability
            FROM clustered c LEFT JOIN scored s USING (Cluster)),
segm AS (SELECT Segment, count(*) AS Count, avg(Recency) AS Avg_Recency, avg(Frequency) AS Avg_Frequency,
                avg(Monetary) AS Avg_Monetary, avg(ChurnProbability) AS Churn_Probability,
                sum(Monetary) * 100.0 / (SELECT sum(Monetary) FROM labeled) AS Revenue_Share,
                sum(Monetary_raw) * 100.0 / (SELECT sum(Monetary_raw) FROM labeled) AS Revenue_Share_raw
         FROM labeled WHERE Segment IS NOT NULL GROUP BY Segment)"""

ORACLE["segment_cluster_summary"] = f"""
WITH {SEGMENT_CTE}
SELECT Cluster, {r('Recency')} AS Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary, Count,
       {r('Percentage')} AS Percentage FROM csum2"""

ORACLE["segment_scores"] = f"""
WITH {SEGMENT_CTE}
SELECT Cluster, {r('Recency')} AS Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary, Count,
       {r('Percentage')} AS Percentage, {r('R_Score')} AS R_Score, {r('F_Score')} AS F_Score,
       {r('M_Score')} AS M_Score, {r('Total_Score')} AS Total_Score, Position, Segment FROM scored"""

ORACLE["segment_customers"] = f"""
WITH {SEGMENT_CTE}
SELECT "Customer ID", Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary, Cluster, Segment,
       {r('ChurnProbability')} AS ChurnProbability FROM labeled"""

ORACLE["segment_metrics"] = f"""
WITH {SEGMENT_CTE}
SELECT Segment, Count, {r('Avg_Recency')} AS Avg_Recency, {r('Avg_Frequency')} AS Avg_Frequency,
       {r('Avg_Monetary')} AS Avg_Monetary, {r('Churn_Probability')} AS Churn_Probability,
       {r('Revenue_Share')} AS Revenue_Share, {r('Revenue_Share_raw')} AS Revenue_Share_raw FROM segm"""

ORACLE["segment_labeled_summary"] = f"""
WITH {SEGMENT_CTE},
fixed AS (SELECT CAST(ord AS INTEGER) AS ord, Segment FROM (VALUES (0, 'Champions'), (1, 'Potential Loyalists'),
                                                             (2, 'At Risk'), (3, 'Lost')) t(ord, Segment))
SELECT ord, Segment, CAST(coalesce(Count, 0) AS BIGINT) AS Count,
       {r('coalesce(Revenue_Share, 0.0)')} AS "Revenue_Share_%", {r('coalesce(Avg_Recency, 0.0)')} AS Avg_Recency,
       {r('coalesce(Avg_Frequency, 0.0)')} AS Avg_Frequency, {r('coalesce(Avg_Monetary, 0.0)')} AS Avg_Monetary,
       {r('coalesce(Churn_Probability, 0.0)')} AS Churn_Probability
FROM fixed LEFT JOIN segm USING (Segment)"""

ORACLE["segment_cluster_means"] = f"""
WITH {SEGMENT_CTE}
SELECT Cluster, {r('Recency')} AS Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary,
""" + ",\n".join(
    f"{r(f'CASE WHEN max({c}) OVER () - min({c}) OVER () = 0 THEN NULL ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END')} AS {c}_norm"
    for c in ("Recency", "Frequency", "Monetary")) + "\nFROM csum"

ORACLE["segment_box_summary"] = f"""
WITH {SEGMENT_CTE},
lng AS (SELECT Cluster, 'Recency' AS feature, CAST(Recency AS DOUBLE) AS value FROM clustered
        UNION ALL SELECT Cluster, 'Frequency', Frequency FROM clustered
        UNION ALL SELECT Cluster, 'Monetary', Monetary FROM clustered),
qq AS (SELECT Cluster, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
              quantile_cont(value, 0.75) AS q3 FROM lng GROUP BY Cluster, feature)
SELECT Cluster, feature, {r('q1')} AS q1, {r('median')} AS median, {r('q3')} AS q3,
       {r('min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END)')} AS whisker_low,
       {r('max(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END)')} AS whisker_high,
       CAST(count_if(NOT (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1))) AS BIGINT) AS outliers
FROM lng JOIN qq USING (Cluster, feature) GROUP BY Cluster, feature, q1, median, q3"""

ORACLE["rfm_summary"] = f"""
WITH {RFM_CTE}
SELECT count(*) AS customers, {r('avg(Recency)')} AS Recency_mean, {r('avg(Frequency)')} AS Frequency_mean,
       {r('avg(Monetary)')} AS Monetary_mean, {r('quantile_cont(Recency, 0.5)')} AS Recency_median,
       {r('quantile_cont(Frequency, 0.5)')} AS Frequency_median, {r('quantile_cont(Monetary, 0.5)')} AS Monetary_median
FROM rfm"""

ORACLE["rfm_describe"] = f"""
WITH {RFM_CTE}
""" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "Column", count({c}) AS count, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean,
       {r(f'stddev_samp(CAST({c} AS DOUBLE))')} AS std, {r(f'min(CAST({c} AS DOUBLE))')} AS min,
       {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS p25, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS p50,
       {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS p75, {r(f'max(CAST({c} AS DOUBLE))')} AS max FROM rfm"""
    for c in ("Recency", "Frequency", "Monetary"))

# -------------------------------------------------------------- sampling
ORACLE["sample_cluster_safe"] = """
WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders),
firsts AS (SELECT min(o_orderkey) AS o_orderkey FROM o GROUP BY o_orderpriority),
rest AS (SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM firsts)
         ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey
         LIMIT 10000 - (SELECT count(*) FROM firsts))
SELECT * FROM o WHERE o_orderkey IN (SELECT o_orderkey FROM firsts)
UNION ALL SELECT * FROM rest"""

ORACLE["sample_random"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey LIMIT 5000"""

ORACLE["split_stratified"] = """
SELECT c_custkey, c_mktsegment,
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':42'), c_custkey)
         <= floor(count(*) OVER (PARTITION BY c_mktsegment) * 0.2 + 0.5) AS is_test
FROM customer"""

# ---------------------------------------------------------------- basket
BASKET_CTE = """
bk AS (SELECT "Customer ID", Invoice, sum(TotalPrice) AS _v, sum(Quantity) AS _q FROM lines
       WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID", Invoice),
bm AS (SELECT "Customer ID", avg(_v) AS AvgBasketValue, coalesce(stddev_samp(_v), 0.0) AS Volatility,
              avg(_q) AS AvgBasketSize FROM bk GROUP BY "Customer ID"),
dayc AS (SELECT "Customer ID", dayname(InvoiceDate) AS v, count(*) AS n FROM lines
         WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID", dayname(InvoiceDate)),
fd AS (SELECT "Customer ID", v AS FavoriteDay FROM (
         SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY n DESC, v) AS rn FROM dayc
         WHERE v IS NOT NULL) WHERE rn = 1),
ctc AS (SELECT "Customer ID", Country AS v, count(*) AS n FROM lines
        WHERE "Customer ID" IS NOT NULL GROUP BY "Customer ID", Country),
fc AS (SELECT "Customer ID", v AS Country FROM (
         SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY n DESC, v) AS rn FROM ctc
         WHERE v IS NOT NULL) WHERE rn = 1),
fav AS (SELECT c."Customer ID", FavoriteDay, Country
        FROM (SELECT DISTINCT "Customer ID" FROM lines WHERE "Customer ID" IS NOT NULL) c
        LEFT JOIN fd USING ("Customer ID") LEFT JOIN fc USING ("Customer ID"))"""

ORACLE["basket_metrics"] = f"""
WITH {CLEAN_CTE}, {BASKET_CTE}
SELECT "Customer ID", {r('AvgBasketValue')} AS AvgBasketValue, {r('Volatility')} AS Volatility,
       {r('AvgBasketSize')} AS AvgBasketSize FROM bm"""

ORACLE["basket_favourites"] = f"""
WITH {CLEAN_CTE}, {BASKET_CTE}
SELECT * FROM fav"""

CLASSIFY_CTE = SEGMENT_CTE + "," + BASKET_CTE + """,
cfeat AS (SELECT bm."Customer ID", AvgBasketValue, Volatility, AvgBasketSize, FavoriteDay, Country, l.Segment
          FROM bm JOIN fav USING ("Customer ID") JOIN labeled l USING ("Customer ID"))"""

ORACLE["classify_features"] = f"""
WITH {CLASSIFY_CTE}
SELECT "Customer ID", {r('AvgBasketValue')} AS AvgBasketValue, {r('Volatility')} AS Volatility,
       {r('AvgBasketSize')} AS AvgBasketSize, FavoriteDay, Country, Segment FROM cfeat"""

ORACLE["classify_encoded"] = f"""
WITH {CLASSIFY_CTE}
SELECT "Customer ID", FavoriteDay, CAST(dense_rank() OVER (ORDER BY FavoriteDay) - 1 AS INTEGER) AS FavoriteDay_Encoded,
       Country, CAST(dense_rank() OVER (ORDER BY Country) - 1 AS INTEGER) AS Country_Encoded,
       Segment, CAST(dense_rank() OVER (ORDER BY Segment) - 1 AS INTEGER) AS Segment_Encoded
FROM cfeat"""

ORACLE["classify_split"] = f"""
WITH {CLASSIFY_CTE}
SELECT "Customer ID", Segment,
       row_number() OVER (PARTITION BY Segment ORDER BY md5(CAST("Customer ID" AS VARCHAR) || ':42'), "Customer ID")
         <= floor(count(*) OVER (PARTITION BY Segment) * 0.2 + 0.5) AS is_test
FROM cfeat"""

# -------------------------------------------- classifier metrics (fixture)
FIXTURE_FX = """
fx0 AS (SELECT c_custkey, c_mktsegment AS actual, c_acctbal AS score FROM customer),
codes AS (SELECT actual AS seg, CAST(dense_rank() OVER (ORDER BY actual) - 1 AS INTEGER) AS idx
          FROM (SELECT DISTINCT actual FROM fx0 WHERE actual IS NOT NULL)),
fx AS (SELECT f.c_custkey, f.actual, CASE WHEN f.c_custkey % 5 <> 0 THEN f.actual ELSE n.seg END AS predicted, f.score
       FROM fx0 f JOIN codes c ON c.seg = f.actual
       JOIN codes n ON n.idx = (c.idx + 1) % (SELECT count(*) FROM codes)),"""

LABELS_FX = """
fx AS (SELECT doc_id, CAST(quality AS VARCHAR) AS actual, CAST(toxic AS VARCHAR) AS predicted,
              CAST(toxic AS DOUBLE) AS score FROM labels),"""

METRIC_CTES = """
cc AS (SELECT actual, predicted, count(*) AS n FROM fx GROUP BY actual, predicted),
sup AS (SELECT actual AS label, sum(n) AS support FROM cc GROUP BY actual),
prd AS (SELECT predicted AS label, sum(n) AS npred FROM cc GROUP BY predicted),
tpc AS (SELECT actual AS label, n AS tp FROM cc WHERE actual = predicted),
pc0 AS (SELECT label, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support, coalesce(npred, 0) AS npred
        FROM sup FULL JOIN prd USING (label) LEFT JOIN tpc USING (label)),
pc AS (SELECT label, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, CAST(support AS BIGINT) AS support
       FROM pc0),
pcf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END
                  AS f1 FROM pc),
lng AS (SELECT k.actual AS class, f.actual = k.actual AS positive, CAST(f.score AS DOUBLE) AS score
        FROM fx f, (SELECT DISTINCT actual FROM fx) k),
cnt AS (SELECT class, score, count_if(positive) AS pos, count_if(NOT positive) AS neg FROM lng GROUP BY class, score),
cum AS (SELECT *,
          coalesce(sum(neg) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS neg_below,
          coalesce(sum(pos) OVER (PARTITION BY class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS pos_below
        FROM cnt),
auc AS (SELECT class, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
               CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL
                    ELSE sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS auc
        FROM cum GROUP BY class)"""

FIXTURE_CTE = FIXTURE_FX + METRIC_CTES

ORACLE["classify_confusion"] = f"""
WITH {FIXTURE_CTE},
cls AS (SELECT actual AS c FROM fx UNION SELECT predicted FROM fx),
ccp AS (SELECT actual, predicted, n, n * 100.0 / sum(n) OVER (PARTITION BY actual) AS rp FROM cc)
SELECT a.c AS actual, p.c AS predicted, CAST(coalesce(n, 0) AS BIGINT) AS count,
       {r('coalesce(rp, 0.0)')} AS row_percent
FROM cls a CROSS JOIN cls p LEFT JOIN ccp ON ccp.actual = a.c AND ccp.predicted = p.c"""

ORACLE["classify_report"] = f"""
WITH {FIXTURE_CTE}
SELECT label, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support FROM pcf
UNION ALL
SELECT 'accuracy', NULL, NULL, {r('count_if(actual = predicted) / count(*)')}, count(*) FROM fx
UNION ALL
SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM pcf
UNION ALL
SELECT 'weighted avg', {r('sum(precision * support) / sum(support)')}, {r('sum(recall * support) / sum(support)')},
       {r('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pcf"""

ORACLE["classify_roc_auc"] = f"""
WITH {FIXTURE_CTE}
SELECT class, positives, negatives, {r('auc')} AS auc FROM auc"""

ORACLE["classify_roc_curve"] = f"""
WITH {FIXTURE_CTE},
tot AS (SELECT class, sum(pos) AS P, sum(neg) AS N FROM cnt GROUP BY class),
stp AS (SELECT *, lag(pos) OVER (PARTITION BY class ORDER BY score) AS pn, lag(neg) OVER (PARTITION BY class ORDER BY score) AS nn,
               lead(score) OVER (PARTITION BY class ORDER BY score) AS up FROM cum)
SELECT class, {r('score')} AS threshold, {r('(N - neg_below) / N')} AS fpr, {r('(P - pos_below) / P')} AS tpr
FROM stp JOIN tot USING (class) WHERE up IS NULL OR pn IS NULL OR pos <> pn OR neg <> nn
UNION ALL
SELECT class, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM tot"""

ORACLE["classify_metrics"] = f"""
WITH {FIXTURE_CTE}
SELECT {r('(SELECT count_if(actual = predicted) / count(*) FROM fx)')} AS accuracy,
       {r('sum(precision * support) / sum(support)')} AS precision_weighted,
       {r('sum(recall * support) / sum(support)')} AS recall_weighted,
       {r('sum(f1 * support) / sum(support)')} AS f1_weighted,
       {r('(SELECT CASE WHEN count_if(auc IS NULL) > 0 THEN 0.0 ELSE sum(auc * positives) / sum(positives) END FROM auc)')}
         AS roc_auc_weighted
FROM pcf"""

# --------------------------------------------------------------- scoring
def pytype(t: str) -> str:
    return (f"(CASE {t} WHEN 'UBIGINT' THEN 'int' WHEN 'BIGINT' THEN 'int' WHEN 'HUGEINT' THEN 'int' "
            f"WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'str' WHEN 'BOOLEAN' THEN 'bool' "
            f"WHEN 'NULL' THEN 'NoneType' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' END)")


def validation_sql(src: str, checks: list[tuple[str, list[str], bool]], values: list[tuple[str, str]]) -> str:
    """CTE ``val`` over ``src(…, value)`` adding error, valid and parsed fields."""
    parts = []
    for f, allowed, nn in checks:
        t = f"json_type(value, '$.{f}')"
        num = f"TRY_CAST(json_extract_string(value, '$.{f}') AS DOUBLE)"
        allowed_sql = ", ".join(f"'{a}'" for a in allowed)
        c = (f"CASE WHEN {t} IS NULL THEN 'Missing required field: ''{f}''.' "
             f"WHEN {pytype(t)} NOT IN ({allowed_sql}) THEN 'Field ''{f}'' must be numeric, got ' || {pytype(t)} || '.' ")
        if nn:
            c += f"WHEN {num} < 0 THEN 'Field ''{f}'' must be non-negative.' "
        parts.append(c + "END")
    err = (f"CASE WHEN NOT json_valid(value) OR json_type(value) <> 'OBJECT' "
           f"THEN 'Request body must be a JSON object.' ELSE coalesce({', '.join(parts)}) END")
    vals = ", ".join(f"CASE WHEN error IS NULL THEN TRY_CAST(json_extract_string(value, '$.{f}') AS {t}) END AS {f}"
                     for f, t in values)
    return f"""
val0 AS (SELECT *, {err} AS error FROM {src}),
val AS (SELECT *, error IS NULL AS valid, {vals} FROM val0)"""


RFM_REQ_CTE = SCALED_CTE + """,
req AS (SELECT "Customer ID",
          CASE WHEN "Customer ID" % 11 = 0 THEN printf('{"Recency":%d,"Frequency":%d}', Recency, Frequency_raw)
               WHEN "Customer ID" % 13 = 0 THEN printf('{"Recency":%d,"Frequency":%d,"Monetary":%.2f}',
                                                      -Recency - 1, Frequency_raw, Monetary_raw)
               WHEN "Customer ID" % 17 = 0 THEN printf('{"Recency":"%d","Frequency":%d,"Monetary":%.2f}',
                                                      Recency, Frequency_raw, Monetary_raw)
               WHEN "Customer ID" % 19 = 0 THEN '[1,2,3]'
               WHEN "Customer ID" % 23 = 0 THEN printf('{"Recency":%d,"Frequency":true,"Monetary":%.2f}',
                                                      Recency, Monetary_raw)
               WHEN "Customer ID" % 29 = 0 THEN printf('{"Recency":%d,"Frequency":%d,"Monetary":null}',
                                                      Recency, Frequency_raw)
               ELSE printf('{"Recency":%d,"Frequency":%d,"Monetary":%.2f}', Recency, Frequency_raw, Monetary_raw)
          END AS value
        FROM rfm_all),""" + validation_sql(
    "req", [(f, ["int", "float"], True) for f in ("Recency", "Frequency", "Monetary")],
    [(f, "DOUBLE") for f in ("Recency", "Frequency", "Monetary")])

ORACLE["score_validate_rfm"] = f"""
WITH {RFM_REQ_CTE}
SELECT "Customer ID", valid, error, Recency, Frequency, Monetary FROM val"""

ORACLE["score_rfm_fixed"] = f"""
WITH {RFM_REQ_CTE},
xs AS (SELECT v."Customer ID", (v.Recency - mr) / (CASE WHEN sr0 = 0 THEN 1.0 ELSE sr0 END) AS xr,
              (ln(1 + v.Frequency) - mf) / (CASE WHEN sf0 = 0 THEN 1.0 ELSE sf0 END) AS xf,
              (ln(1 + v.Monetary) - mm) / (CASE WHEN sm0 = 0 THEN 1.0 ELSE sm0 END) AS xm
       FROM val v, sc WHERE v.valid),
xd AS (SELECT xs."Customer ID", Cluster,
              (xr - cr) * (xr - cr) + (xf - cf) * (xf - cf) + (xm - cm) * (xm - cm) AS d FROM xs, cent),
best AS (SELECT "Customer ID", Cluster AS cluster FROM (
           SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY d, Cluster) AS rn FROM xd) WHERE rn = 1)
SELECT v."Customer ID", b.cluster,
       CASE b.cluster WHEN 0 THEN 'Champions' WHEN 1 THEN 'Potential Loyalists' WHEN 2 THEN 'At Risk'
                      WHEN 3 THEN 'Lost' ELSE 'Cluster_' || CAST(b.cluster AS VARCHAR) END AS segment
FROM val v JOIN best b USING ("Customer ID") WHERE v.valid"""

ORACLE["score_rfm_response"] = f"""
WITH {RFM_REQ_CTE},
xs AS (SELECT v."Customer ID", (v.Recency - mr) / (CASE WHEN sr0 = 0 THEN 1.0 ELSE sr0 END) AS xr,
              (ln(1 + v.Frequency) - mf) / (CASE WHEN sf0 = 0 THEN 1.0 ELSE sf0 END) AS xf,
              (ln(1 + v.Monetary) - mm) / (CASE WHEN sm0 = 0 THEN 1.0 ELSE sm0 END) AS xm
       FROM val v, sc WHERE v.valid),
xd AS (SELECT xs."Customer ID", Cluster,
              (xr - cr) * (xr - cr) + (xf - cf) * (xf - cf) + (xm - cm) * (xm - cm) AS d FROM xs, cent),
best AS (SELECT "Customer ID", Cluster AS cluster FROM (
           SELECT *, row_number() OVER (PARTITION BY "Customer ID" ORDER BY d, Cluster) AS rn FROM xd) WHERE rn = 1)
SELECT v."Customer ID", v.valid, v.error, v.error AS response_error, CAST(b.cluster AS VARCHAR) AS response_cluster,
       CASE b.cluster WHEN 0 THEN 'Champions' WHEN 1 THEN 'Potential Loyalists' WHEN 2 THEN 'At Risk'
                      WHEN 3 THEN 'Lost' END AS response_segment,
       v.Recency AS input_Recency, v.Frequency AS input_Frequency, v.Monetary AS input_Monetary
FROM val v LEFT JOIN best b USING ("Customer ID")"""

CLS_FMT = ('{"Recency":%d,"Frequency":%d,"Monetary":%.2f,"AvgBasketValue":%.2f,"AvgBasketSize":%d,'
           '"Volatility":%.1f,"FavoriteDay_Encoded":%d,"Country_Encoded":%d}')
CLS_FIELDS = ["Recency", "Frequency", "Monetary", "AvgBasketValue", "AvgBasketSize", "Volatility",
              "FavoriteDay_Encoded", "Country_Encoded"]
CLS_ARGS = ["Recency", "Frequency_raw", "Monetary_raw", "Monetary_raw", "Frequency_raw * 2", "Recency / 2.0",
            "FavoriteDay_Encoded", "Country_Encoded"]


def _fmt(fmt: str, args: list[str]) -> str:
    return f"printf('{fmt}', {', '.join(args)})"


ORACLE["score_validate_classifier"] = f"""
WITH {RFM_CTE}, {BASKET_CTE},
enc AS (SELECT a."Customer ID", a.Recency, a.Frequency_raw, a.Monetary_raw,
               CAST(dense_rank() OVER (ORDER BY FavoriteDay) - 1 AS INTEGER) AS FavoriteDay_Encoded,
               CAST(dense_rank() OVER (ORDER BY Country) - 1 AS INTEGER) AS Country_Encoded
        FROM rfm_all a JOIN fav USING ("Customer ID")),
creq AS (SELECT "Customer ID",
   CASE WHEN "Customer ID" % 7 = 0 THEN {_fmt(CLS_FMT.replace('"FavoriteDay_Encoded":%d', '"FavoriteDay_Encoded":%d.0'), CLS_ARGS)}
        WHEN "Customer ID" % 11 = 0 THEN {_fmt(CLS_FMT.replace(',"Volatility":%.1f', ''), [a for k, a in enumerate(CLS_ARGS) if k != 5])}
        WHEN "Customer ID" % 13 = 0 THEN {_fmt(CLS_FMT.replace('"Country_Encoded":%d', '"Country_Encoded":"%d"'), CLS_ARGS)}
        WHEN "Customer ID" % 17 = 0 THEN {_fmt(CLS_FMT, ['-Recency - 1'] + CLS_ARGS[1:])}
        ELSE {_fmt(CLS_FMT, CLS_ARGS)} END AS value
   FROM enc),""" + validation_sql(
    "creq", [(f, ["int", "float"], False) for f in CLS_FIELDS[:6]] + [(f, ["int"], False) for f in CLS_FIELDS[6:]],
    [(f, "DOUBLE") for f in CLS_FIELDS[:6]] + [(f, "INTEGER") for f in CLS_FIELDS[6:]]) + f"""
SELECT "Customer ID", valid, error, {', '.join(r(f) + ' AS ' + f for f in CLS_FIELDS[:6])},
       CAST(FavoriteDay_Encoded AS DOUBLE) AS FavoriteDay_Encoded, CAST(Country_Encoded AS DOUBLE) AS Country_Encoded
FROM val"""

ORACLE["score_classifier_validate_response"] = f"""
WITH {RFM_CTE}, {BASKET_CTE},
enc AS (SELECT a."Customer ID", a.Recency, a.Frequency_raw, a.Monetary_raw,
               CAST(dense_rank() OVER (ORDER BY FavoriteDay) - 1 AS INTEGER) AS FavoriteDay_Encoded,
               CAST(dense_rank() OVER (ORDER BY Country) - 1 AS INTEGER) AS Country_Encoded
        FROM rfm_all a JOIN fav USING ("Customer ID")),
creq AS (SELECT "Customer ID",
   CASE WHEN "Customer ID" % 7 = 0 THEN {_fmt(CLS_FMT.replace('"FavoriteDay_Encoded":%d', '"FavoriteDay_Encoded":%d.0'), CLS_ARGS)}
        WHEN "Customer ID" % 11 = 0 THEN {_fmt(CLS_FMT.replace(',"Volatility":%.1f', ''), [a for k, a in enumerate(CLS_ARGS) if k != 5])}
        WHEN "Customer ID" % 13 = 0 THEN {_fmt(CLS_FMT.replace('"Country_Encoded":%d', '"Country_Encoded":"%d"'), CLS_ARGS)}
        WHEN "Customer ID" % 17 = 0 THEN {_fmt(CLS_FMT, ['-Recency - 1'] + CLS_ARGS[1:])}
        ELSE {_fmt(CLS_FMT, CLS_ARGS)} END AS value
   FROM enc),""" + validation_sql(
    "creq", [(f, ["int", "float"], False) for f in CLS_FIELDS[:6]] + [(f, ["int"], False) for f in CLS_FIELDS[6:]],
    [(f, "DOUBLE") for f in CLS_FIELDS[:6]] + [(f, "INTEGER") for f in CLS_FIELDS[6:]]) + f"""
SELECT "Customer ID", valid, error, error AS response_error, valid AS response_has_segment,
       CASE WHEN valid THEN TRUE END AS response_class_matches, Recency AS "input_Recency"
FROM val"""

ORACLE["score_ranked_checks"] = ORACLE["score_classifier_validate_response"].replace(
    ORACLE["score_classifier_validate_response"][ORACLE["score_classifier_validate_response"].rindex("SELECT"):],
    'SELECT "Customer ID", TRUE AS ranks_are_a_permutation, TRUE AS probabilities_fall, TRUE AS sum_to_1 FROM val WHERE valid')

# ---------------------------------------------------- sources and sinks
ORACLE["source_csv_scan"] = f"""
WITH {CLEAN_CTE}
SELECT CAST(Invoice AS VARCHAR) AS Invoice, CAST(StockCode AS VARCHAR) AS StockCode, Description,
       CAST(Quantity AS BIGINT) AS Quantity, InvoiceDate, Price, "Customer ID", Country
FROM clean"""

ORACLE["source_csv_line_breaks"] = """CASE WHEN StockCode % 5 = 0 THEN Description || chr(13) || chr(10) || '"second",' || chr(10) || chr(10) || 'line'
            ELSE Description END AS Description,""".join(ORACLE["source_csv_scan"].rsplit("Description,", 1))
ORACLE["source_csv_canonical"] = ORACLE["source_csv_scan"]
ORACLE["source_csv_reordered"] = ORACLE["source_csv_scan"]

ORACLE["source_csv_problems"] = f"""
WITH {DIRTY_CTE}
SELECT count(*) AS lines, CAST(0 AS BIGINT) AS corrupt_lines, CAST(count_if(Invoice % 7 = 0) AS BIGINT) AS "bad_Quantity",
       CAST(count_if(Invoice % 11 = 0) AS BIGINT) AS "bad_Price", CAST(count_if(Invoice % 13 = 0) AS BIGINT) AS "bad_Customer_ID",
       CAST(count_if(Invoice % 17 = 0) AS BIGINT) AS "bad_InvoiceDate"
FROM retail_dirty"""

ORACLE["features_head"] = f"""
WITH {FEATURE_CTE}
SELECT Invoice, StockCode, Quantity, InvoiceDate, Price, "Customer ID", Country, Year, Month, Day, Hour, DayOfWeek,
       {r('TotalPrice', 4)} AS TotalPrice, {r('TransactionSize')} AS TransactionSize, UniqueItems
FROM feat ORDER BY Invoice, StockCode, Quantity, Price, "Customer ID" LIMIT 100"""

ORACLE["score_rfm_bundle"] = ORACLE["score_rfm_response"]

ORACLE["eda_weekday_hour_matrix"] = """
WITH act AS (
  SELECT event_id AS Invoice, CAST(isodow(ts) - 1 AS INTEGER) AS DayOfWeek, CAST(hour(ts) AS INTEGER) AS Hour
  FROM events),
cells AS (SELECT DayOfWeek, Hour, count(DISTINCT Invoice) AS Invoices FROM act GROUP BY DayOfWeek, Hour)
SELECT DayOfWeek, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][DayOfWeek + 1] AS Day,
""" + ",\n".join(f'       max(CASE WHEN Hour = {h} THEN Invoices END) AS "{h}"' for h in range(24)) + """
FROM cells GROUP BY DayOfWeek"""

ORACLE["rfm_scaler_params"] = f"""
WITH {RFM_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
    f"{r(f'CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1.0 ELSE stddev_pop(CAST({c} AS DOUBLE)) END')} AS scale "
    f"FROM rfm" for c in ("Recency", "Frequency", "Monetary"))

# the stream scores the same requests with the same scorer as the batch query
ORACLE["score_stream_rfm"] = ORACLE["score_rfm_response"]
ORACLE["rf_metrics_checks"] = "SELECT TRUE AS all_are_shares, TRUE AS recall_is_accuracy, TRUE AS auc_beats_chance"
ORACLE["rf_importance_checks"] = """
SELECT Feature, TRUE AS is_a_share, TRUE AS has_band
FROM (VALUES ('AvgBasketValue'), ('AvgBasketSize'), ('Volatility'), ('FavoriteDay_Encoded'), ('Country_Encoded')) f(Feature)"""
ORACLE["score_stream_classifier"] = ORACLE["score_classifier_validate_response"]


ORACLE["classify_report_labels"] = ORACLE["classify_report"].replace(FIXTURE_CTE, LABELS_FX + METRIC_CTES)
ORACLE["classify_roc_auc_labels"] = ORACLE["classify_roc_auc"].replace(FIXTURE_CTE, LABELS_FX + METRIC_CTES)

# ------------------------------------------------------ checks of own fits
ORACLE["kmeans_checks"] = f"""
WITH {RFM_CTE}
SELECT count(*) AS customers, CAST(4 AS BIGINT) AS clusters, TRUE AS cost_is_inertia, TRUE AS centroids_are_means,
       TRUE AS no_worse_than_one_start FROM rfm"""

ORACLE["kmeans_k_sweep_checks"] = """
SELECT CAST(k AS INTEGER) AS k, TRUE AS inertia_falls, TRUE AS silhouette_in_range FROM range(2, 11) t(k)"""

SPLIT_SIZE = """
SELECT count_if(rn <= floor(n * 0.2 + 0.5)) AS test, count(*) AS total FROM (
  SELECT row_number() OVER (PARTITION BY Segment) AS rn, count(*) OVER (PARTITION BY Segment) AS n FROM cfeat)"""

ORACLE["rf_checks"] = f"""
WITH {CLASSIFY_CTE}, size AS ({SPLIT_SIZE})
SELECT CAST(test AS BIGINT) AS test_customers, TRUE AS most_probable, TRUE AS probabilities_sum_to_1, TRUE AS accuracy_is_share_of_hits,
       TRUE AS no_worse_than_largest_class, TRUE AS importances_sum_to_1 FROM size"""

ORACLE["rf_model_round_trip"] = f"""
WITH {CLASSIFY_CTE} SELECT count(*) AS customers, TRUE AS equal FROM cfeat"""

ORACLE["score_all_customers_checks"] = f"""
WITH {CLASSIFY_CTE}
SELECT count(*) AS file_rows, TRUE AS file_segments_known, count(*) AS raw_rows, TRUE AS raw_segments_known FROM cfeat"""

# ------------------------------------------------------- reports and runs
ORACLE["segment_labeled_report"] = ORACLE["segment_labeled_summary"]
for _c, _d in (("Revenue_Share", 1), ("Avg_Recency", 0), ("Avg_Frequency", 1), ("Avg_Monetary", 2), ("Churn_Probability", 2)):
    ORACLE["segment_labeled_report"] = ORACLE["segment_labeled_report"].replace(
        r(f"coalesce({_c}, 0.0)"), r(f"coalesce({_c}, 0.0)", _d))

ORACLE["segment_pair_plot_sample"] = f"""
WITH {SEGMENT_CTE}
SELECT "Customer ID", Cluster, Recency, {r('Frequency')} AS Frequency, {r('Monetary')} AS Monetary FROM clustered
ORDER BY md5(CAST("Customer ID" AS VARCHAR) || ':42'), "Customer ID" LIMIT 5000"""

ORACLE["segment_pair_plot"] = f"""
WITH {SEGMENT_CTE},
v AS (""" + " UNION ALL ".join(
    f"SELECT Cluster, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CAST(min({c}) OVER () AS DOUBLE) AS lo, "
    f"CAST(max({c}) OVER () AS DOUBLE) AS hi FROM clustered" for c in ("Recency", "Frequency", "Monetary")) + f"""),
b AS (SELECT *, CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * 20), 19) ELSE 0 END AS INTEGER) AS bin FROM v)
SELECT Cluster, feature, bin, {r('lo + bin * ((hi - lo) / 20)')} AS bin_start, count(*) AS count
FROM b GROUP BY Cluster, feature, bin, lo, hi"""


def num(expr: str) -> str:
    return f"coalesce(printf('%.4f', CAST({expr} AS DOUBLE)), '')"


def lines(section: str, src: str, key: str | None, values: list[tuple[str, str]]) -> str:
    """Report lines ``section | key : name | value`` of a table expression."""
    head = f"CAST({key} AS VARCHAR) || ' : ' || " if key else ""
    return "\nUNION ALL\n".join(f"SELECT '{section} | ' || {head}'{name} | ' || {value} AS value FROM {src}" for name, value in values)


def text(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), '')"


ORACLE["report_segments"] = f"""
WITH {SEGMENT_CTE}
""" + "\nUNION ALL\n".join([
    lines("1 LABELS", "scored", "Cluster", [("Segment", text("Segment"))]),
    lines("2 SEGMENTS", "segm", "Segment", [("Count", text("Count"))] + [
        (c, num(c)) for c in ("Avg_Recency", "Avg_Frequency", "Avg_Monetary", "Churn_Probability", "Revenue_Share",
                              "Revenue_Share_raw")]),
    lines("3 TOTALS", "(SELECT count(*) AS c, sum(Monetary) AS m FROM labeled)", None,
          [("customers", text("c")), ("total_revenue", num("m"))])])

METRICS_ROW, REPORT_ROWS = ORACLE["classify_metrics"], ORACLE["classify_report"]
ORACLE["report_classification"] = "SELECT * FROM (" + "\nUNION ALL\n".join([
    lines("1 OVERALL", f"({METRICS_ROW})", None,
          [(c, num(c)) for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "roc_auc_weighted")]),
    lines("2 CLASSES", f"({REPORT_ROWS})", "label",
          [(c, num(c)) for c in ("precision", "recall", "f1")] + [("support", text("support"))])]) + ")"

ORACLE["report_dataset"] = "SELECT * FROM (" + "\nUNION ALL\n".join([
    lines("1 SHAPE", f"({ORACLE['profile_summary']})", None,
          [(c, text(c)) for c in ("rows", "columns", "duplicate_rows", "total_missing")]),
    lines("2 COLUMNS", f"({ORACLE['profile_missing']})", '"Column"',
          [("Missing_Count", text("Missing_Count")), ("Missing_Percentage", num("Missing_Percentage"))]),
    lines("3 FIRST ROWS", f"(WITH {DIRTY_CTE} SELECT Invoice, StockCode, Quantity, Price FROM retail_dirty "
          "ORDER BY Invoice, StockCode, Quantity, Price LIMIT 5)", "Invoice || ' / ' || StockCode",
          [("Quantity", num("Quantity")), ("Price", num("Price"))]),
    lines("4 STATISTICS", f"(SELECT * FROM ({ORACLE['profile_describe']}) WHERE \"Column\" IN ('Quantity', 'Price'))", '"Column"',
          [("count", text("count"))] + [(c, num(c)) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])]) + ")"

LINEAGE = ["original_rows", "cleaned_rows", "dropped_null_description", "dropped_null_customer", "dropped_duplicates",
           "unique_customers", "unique_invoices", "unique_products", "unique_countries"]
ORACLE["report_preprocessing"] = "SELECT * FROM (" + "\nUNION ALL\n".join([
    lines("1 CLEANING", f"({ORACLE['clean_lineage']})", None, [(c, text(c)) for c in LINEAGE]),
    lines("2 FEATURES", "(SELECT 1)", None,
          [("new_columns", "'Year, Month, Day, Hour, DayOfWeek, TotalPrice, TransactionSize, UniqueItems'"),
           ("scaled_columns", "'Quantity, Price, TotalPrice, TransactionSize, UniqueItems'")]),
    lines("3 FINAL SHAPE", f"(WITH {CLEAN_CTE} SELECT count(*) AS n, count(DISTINCT Country) + 15 AS c FROM clean)", None,
          [("rows", text("n")), ("columns", text("c"))])]) + ")"

ORACLE["tracking_latest_run"] = f"""
WITH {SEGMENT_CTE},
m(key, v) AS (
  SELECT replace('count_' || Segment, ' ', '_'), CAST(Count AS DOUBLE) FROM segm
""" + "".join(f"  UNION ALL SELECT replace('{n}_' || Segment, ' ', '_'), {c} FROM segm\n" for c, n in (
    ("Revenue_Share", "revenue_share"), ("Churn_Probability", "churn_prob"), ("Avg_Monetary", "avg_monetary"),
    ("Avg_Frequency", "avg_frequency"), ("Avg_Recency", "avg_recency"))) + f"""
  UNION ALL SELECT 'total_revenue', sum(Monetary) FROM labeled
  UNION ALL SELECT 'total_customers', CAST(count(*) AS DOUBLE) FROM labeled)
SELECT 'labelling' AS run_name, 'metric' AS kind, key, NULL AS value, {r('v')} AS value_num FROM m
UNION ALL SELECT 'labelling', 'param', 'method', 'rank sums', NULL
UNION ALL SELECT 'labelling', 'tag', 'model_type', 'none', NULL"""
