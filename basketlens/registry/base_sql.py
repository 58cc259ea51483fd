"""Common table expressions the expected-result SQL builds on."""

from __future__ import annotations

CUTOFF = "2000-08-01"

C360 = f"""
h AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}'),
li AS (SELECT h.o_custkey, h.o_orderkey, l.*, (l.l_extendedprice * (1 - l.l_discount))::DECIMAL(18,4) AS net
       FROM h JOIN lineitem l ON l.l_orderkey = h.o_orderkey),
per_order AS (SELECT o_custkey, o_orderkey, sum(net) AS net, count(*) AS n_lines, count(DISTINCT l_partkey) AS parts
              FROM li GROUP BY 1, 2),
money AS (SELECT o_custkey, sum(net)::DOUBLE AS total, sum(net)::DOUBLE / count(*) AS mean, stddev_samp(net::DOUBLE) AS std,
                 min(net)::DOUBLE AS low, max(net)::DOUBLE AS high, count(*) AS with_lines, avg(parts) AS parts
          FROM per_order GROUP BY 1),
line_stats AS (
  SELECT o_custkey, sum(l_quantity) AS qty, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_extendedprice = 0) AS zero,
         count(DISTINCT l_partkey) AS products, count(DISTINCT p_name) AS names, count(DISTINCT s_nationkey) AS nations
  FROM li LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1),
order_stats AS (
  SELECT o_custkey, count(DISTINCT o_orderkey) AS freq, max(o_orderdate)::DATE AS last_day, min(o_orderdate)::DATE AS first_day,
         count(*) FILTER (WHERE isodow(o_orderdate) >= 6) AS weekend,
         count(*) FILTER (WHERE o_orderstatus = 'P') AS cancelled
  FROM h GROUP BY 1),
modes AS (
  SELECT o_custkey, 'dow' AS kind, (isodow(o_orderdate) - 1)::VARCHAR AS v, isodow(o_orderdate) - 1 AS num, count(*) AS n FROM h GROUP BY ALL
  UNION ALL SELECT o_custkey, 'month', month(o_orderdate)::VARCHAR, month(o_orderdate), count(*) FROM h GROUP BY ALL
  UNION ALL SELECT o_custkey, 'prio', o_orderpriority, 0, count(*) FROM h GROUP BY ALL
  UNION ALL SELECT user_id, 'hour', hour(ts)::VARCHAR, hour(ts), count(*) FROM events GROUP BY ALL),
best AS (SELECT * FROM modes QUALIFY row_number() OVER (PARTITION BY o_custkey, kind ORDER BY n DESC, num, v) = 1),
c360 AS (
  SELECT c_custkey AS CustomerID,
    CASE WHEN EXISTS (SELECT 1 FROM orders o2 WHERE o2.o_custkey = c_custkey AND o2.o_orderdate >= TIMESTAMP '{CUTOFF}')
         THEN 0 ELSE 1 END AS Churn,
    DATE '{CUTOFF}' - last_day AS Recency, freq AS Frequency, freq AS UniqueInvoices,
    total AS MonetaryTotal, mean AS MonetaryAvg, std AS MonetaryStd, low AS MonetaryMin, high AS MonetaryMax,
    qty AS TotalQuantity, min_qty AS MinQuantity, max_qty AS MaxQuantity, qty / with_lines AS AvgQuantityPerTransaction,
    last_day - first_day AS CustomerTenureDays, DATE '{CUTOFF}' - first_day AS FirstPurchaseDaysAgo,
    bd.num AS PreferredDayOfWeek, bm.num AS PreferredMonth, bh.num AS PreferredHour, weekend / freq AS WeekendPurchaseRatio,
    CASE WHEN freq > 1 THEN (last_day - first_day) / (freq - 1) END AS AvgDaysBetweenPurchases,
    products AS UniqueProducts, names AS UniqueDescriptions, nations AS UniqueCountries,
    money.parts AS AvgProductsPerTransaction, coalesce(n_lines, 0) AS TotalTransactions,
    coalesce(n_lines, 0) / freq AS AvgLinesPerInvoice, coalesce(returned, 0) AS NegativeQuantityCount,
    returned / n_lines AS ReturnRatio, cancelled AS CancelledTransactions, coalesce(zero, 0) AS ZeroPriceCount,
    c_acctbal AS AccountBalance,
    CASE WHEN c_custkey % 10 >= 3 THEN (18 + (c_custkey * 7919) % 63)::DOUBLE END AS Age,
    CASE WHEN c_custkey % 20 = 0 THEN -1.0::DOUBLE WHEN c_custkey % 33 = 1 THEN 999.0::DOUBLE ELSE (c_custkey % 16)::DOUBLE END
      AS SupportTicketsCount,
    CASE WHEN c_custkey % 25 = 0 THEN -1.0::DOUBLE WHEN c_custkey % 25 = 1 THEN 99.0::DOUBLE
         ELSE (c_custkey % 51)::DOUBLE / 10.0::DOUBLE END AS SatisfactionScore,
    n_name AS Country, r_name AS Region, c_mktsegment AS CustomerType, bp.v AS OrderPriority,
    CASE WHEN c_custkey % 10 <> 9 THEN CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END END AS Gender,
    'Yes' AS NewsletterSubscribed,
    CASE c_custkey % 3 WHEN 0 THEN strftime(first_day, '%d/%m/%y') WHEN 1 THEN strftime(first_day, '%Y-%m-%d')
         ELSE strftime(first_day, '%m/%d/%Y') END AS RegistrationDate,
    CASE WHEN c_custkey % 101 = 0 THEN 'bad'
         ELSE concat_ws('.', (c_custkey * 37) % 256, (c_custkey * 11) % 256, (c_custkey * 7) % 256, c_custkey % 256) END
      AS LastLoginIP
  FROM customer
  JOIN order_stats os ON os.o_custkey = c_custkey
  LEFT JOIN money ON money.o_custkey = c_custkey
  LEFT JOIN line_stats ls ON ls.o_custkey = c_custkey
  LEFT JOIN best bd ON bd.o_custkey = c_custkey AND bd.kind = 'dow'
  LEFT JOIN best bm ON bm.o_custkey = c_custkey AND bm.kind = 'month'
  LEFT JOIN best bp ON bp.o_custkey = c_custkey AND bp.kind = 'prio'
  LEFT JOIN best bh ON bh.o_custkey = c_custkey AND bh.kind = 'hour'
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
"""

# Appended to C360: exact stratified split on hashed keys, largest remainders first.
SPLIT = """
class_n AS (SELECT Churn, count(*) AS n FROM c360 GROUP BY 1),
test_n AS (
  SELECT Churn, floor(e)::BIGINT + (CASE WHEN row_number() OVER (ORDER BY e - floor(e) DESC, Churn)
         <= t - sum(floor(e)) OVER () THEN 1 ELSE 0 END) AS k
  FROM (SELECT Churn, ceil(0.2 * sum(n) OVER ()) AS t, ceil(0.2 * sum(n) OVER ()) * n / sum(n) OVER () AS e FROM class_n)),
split AS (
  SELECT c.*, CASE WHEN row_number() OVER (PARTITION BY c.Churn ORDER BY md5('split42|' || CustomerID)) <= k
                   THEN 'test' ELSE 'train' END AS side
  FROM c360 c JOIN test_n USING (Churn))
"""

# Appended to C360: the fixed logistic score and its report.
SCORED = """
scored AS (
  SELECT CustomerID, Churn AS label, CASE CustomerID % 50 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.25::DOUBLE WHEN 2 THEN 0.5::DOUBLE
         WHEN 3 THEN 0.75::DOUBLE WHEN 4 THEN 1.0::DOUBLE
         ELSE round(1 / (1 + exp(-(0.003::DOUBLE * Recency - 0.1::DOUBLE * Frequency))), 2) END AS score FROM c360),
report AS (
  SELECT CustomerID, label, score, (score >= 0.5)::INTEGER AS churn_predicted,
         CASE WHEN score <= 0 THEN NULL WHEN score <= 0.25 THEN 'Faible' WHEN score <= 0.5 THEN 'Moyen'
              WHEN score <= 0.75 THEN 'Élevé' WHEN score <= 1 THEN 'Critique' END AS risk_level,
         (score >= 0.5)::INTEGER = label AS correct FROM scored)
"""

# Appended to C360: spend and a fixed prediction.
SPEND = """
spend AS (SELECT CustomerID, MonetaryTotal AS y, TotalQuantity * 2100.0::DOUBLE AS yhat FROM c360 WHERE MonetaryTotal IS NOT NULL)
"""

# Appended to C360: distances to three fixed centres, nearest first centre on ties.
CLUSTERED = """
measured AS (
  SELECT *, [sqrt((Frequency - 6)^2 + (TotalTransactions - 24)^2 + (CustomerTenureDays - 1500)^2 + (FirstPurchaseDaysAgo - 1800)^2),
             sqrt((Frequency - 10)^2 + (TotalTransactions - 40)^2 + (CustomerTenureDays - 1750)^2 + (FirstPurchaseDaysAgo - 1900)^2),
             sqrt((Frequency - 15)^2 + (TotalTransactions - 60)^2 + (CustomerTenureDays - 1850)^2 + (FirstPurchaseDaysAgo - 1950)^2)]
             AS distances FROM c360),
clustered AS (SELECT *, (list_position(distances, list_min(distances)) - 1)::INTEGER AS cluster FROM measured)
"""

# Appended to C360: what-if inputs as text.
_TEXT = """CASE CustomerID % {p} WHEN 0 THEN '  ' WHEN 1 THEN 'n/a' WHEN 2 THEN NULL ELSE ({e})::VARCHAR END AS {c}"""
SCENARIOS = "scenarios AS (SELECT CustomerID, " + ", ".join(
    _TEXT.format(p=p, e=e, c=c)
    for c, e, p in (
        ("Frequency", "Frequency", 7),
        ("MonetaryTotal", "TotalQuantity::INTEGER", 8),
        ("MonetaryAvg", "MinQuantity::INTEGER * 10", 9),
        ("CustomerTenureDays", "CustomerTenureDays", 10),
        ("ReturnRatio", "PreferredDayOfWeek::DOUBLE / 8", 11),
        ("SupportTicketsCount", "SupportTicketsCount::INTEGER", 12),
        ("SatisfactionScore", "PreferredMonth", 13),
        ("Age", "Age::INTEGER", 14),
        ("RegYear", "2000 + PreferredDayOfWeek", 15),
        ("RegMonth", "PreferredMonth", 16),
    )
) + " FROM c360)"


def uniform_sql(salt: str, *keys: str) -> str:
    """Number in [0, 1) from the hash of a salt and keys."""
    text = " || '|' || ".join([f"'{salt}'", *keys])
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
