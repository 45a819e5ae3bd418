"""Named subqueries: raw sheets, clean table, and the customer, product and basket stages.

Names carry the prefix `x_` so that they cannot meet a table of the test data.
"""

from ledgerlark import constants as C
from ledgerlark.catalog import STAR_SETTINGS as S


def texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def any_of(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


TABLES: dict[str, str] = {}

TABLES["x_lines"] = """
SELECT
  CASE WHEN l_orderkey % 101 = 0 THEN 'A'
       WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber <= 3 THEN 'C' ELSE '' END
    || l_orderkey::VARCHAR AS Invoice,
  CASE l_partkey % 400 WHEN 0 THEN 'POST' WHEN 1 THEN 'DOT' WHEN 2 THEN 'M' WHEN 3 THEN 'S' WHEN 4 THEN 'D'
       WHEN 5 THEN 'BANK CHARGES' WHEN 6 THEN 'AMAZONFEE' WHEN 7 THEN 'gift_0001_10'
       ELSE l_partkey::VARCHAR END AS StockCode,
  CASE WHEN l_partkey % 61 = 0 THEN NULL
       WHEN l_partkey % 67 = 0 THEN 'damaged ' || p_name
       WHEN l_partkey % 71 = 0 THEN 'Manual'
       WHEN l_partkey % 73 = 0 THEN 'SAMPLES'
       WHEN l_linenumber = 7 THEN upper(p_name) || ' OLD'
       ELSE upper(p_name) END AS Description,
  CASE WHEN l_orderkey % 101 <> 0 AND (
         (l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber <= 3)
         OR (l_orderkey + l_linenumber) % 211 = 0 OR (l_orderkey * 5 + l_linenumber) % 401 = 0)
       THEN -(l_quantity::BIGINT) ELSE l_quantity::BIGINT END AS Quantity,
  o_orderdate AS InvoiceDate,
  (CASE WHEN (l_orderkey + l_linenumber) % 211 = 0 OR (l_orderkey * 3 + l_linenumber) % 53 = 0 THEN 0
        WHEN (l_orderkey * 7 + l_linenumber) % 997 = 0
        THEN -(floor(l_extendedprice * 100 / l_quantity)::BIGINT * 0.01::DECIMAL(18,4))
        ELSE floor(l_extendedprice * 100 / l_quantity)::BIGINT * 0.01::DECIMAL(18,4) END)::DECIMAL(18,4) AS Price,
  CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_custkey END AS "Customer ID",
  n_name AS Country,
  l_orderkey AS ok
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
"""

TABLES["x_raw"] = """
SELECT * EXCLUDE (ok), 'S1' AS SourceYear FROM x_lines WHERE InvoiceDate < TIMESTAMP '1998-05-01'
UNION ALL SELECT * EXCLUDE (ok), 'S2' FROM x_lines WHERE InvoiceDate >= TIMESTAMP '1998-04-01'
UNION ALL SELECT * EXCLUDE (ok), 'S2' FROM x_lines WHERE InvoiceDate >= TIMESTAMP '1998-05-01' AND ok % 37 = 0
"""

# The clean classifier, rule by rule: a later rule overrides the earlier ones.
TABLES["x_tx"] = f"""
SELECT *, CustomerID IS NOT NULL AS IsCustomerIdentified, TransactionType = '{C.SALE}' AS IsCommercialSale,
  TransactionType = '{C.RETURN}' AS IsReturn, TransactionType = '{C.SALE}' AS IsRevenueEligible
FROM (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, SourceYear,
    InvoicePrefix, InvoicePrefix = 'C' AS IsCancellation, InvoicePrefix = 'A' AS IsAccountingAdjustment,
    (Quantity * UnitPrice)::DECIMAL(18,4) AS LineRevenue,
    list_last(list_filter([
      '{C.OTHER}',
      CASE WHEN InvoicePrefix = 'A' THEN '{C.ACCOUNTING}' END,
      CASE WHEN InvoicePrefix = 'C' AND Quantity < 0 THEN '{C.RETURN}' END,
      CASE WHEN coalesce(InvoicePrefix, '') NOT IN ('A', 'C') AND Quantity < 0 AND UnitPrice = 0 THEN '{C.OPERATIONAL}' END,
      CASE WHEN Quantity > 0 AND UnitPrice = 0 THEN '{C.ZERO_PRICE}' END,
      CASE WHEN coalesce(InvoicePrefix, '') <> 'A' AND UnitPrice < 0 THEN '{C.NEGATIVE_PRICE}' END,
      CASE WHEN Quantity > 0 AND UnitPrice > 0 AND coalesce(InvoicePrefix, '') NOT IN ('A', 'C') THEN '{C.SALE}' END
    ], lambda x: x IS NOT NULL)) AS TransactionType
  FROM (SELECT DISTINCT Invoice AS InvoiceNo, StockCode, Description, Quantity, InvoiceDate, Price AS UnitPrice,
          "Customer ID" AS CustomerID, Country, SourceYear, substr(trim(Invoice), 1, 1) AS InvoicePrefix FROM x_raw)
) WHERE TransactionType <> '{C.OTHER}'
"""

TABLES["x_cust"] = """
SELECT CustomerID, count(*) FILTER (IsRevenueEligible) AS SaleLines,
  count(DISTINCT InvoiceNo) FILTER (IsRevenueEligible) AS SalesOrders,
  count(DISTINCT InvoiceNo) FILTER (IsReturn) AS ReturnOrders,
  coalesce(sum(LineRevenue) FILTER (IsRevenueEligible), 0) AS Gross,
  coalesce(sum(LineRevenue) FILTER (IsReturn), 0) AS Ret,
  sum(LineRevenue) AS NetAll,
  coalesce(sum(Quantity) FILTER (IsRevenueEligible), 0)::BIGINT AS Units,
  coalesce(sum(Quantity) FILTER (IsReturn), 0)::BIGINT AS RetUnits
FROM x_tx WHERE CustomerID IS NOT NULL GROUP BY CustomerID
"""

TABLES["x_prod"] = """
SELECT StockCode, max(Description) AS MaxDescription, count(*) AS Lines,
  count(*) FILTER (IsRevenueEligible) AS SaleLines,
  count(InvoiceNo) FILTER (IsRevenueEligible) AS SalesLines, count(*) FILTER (IsReturn) AS ReturnLines,
  count(DISTINCT InvoiceNo) AS Orders,
  count(DISTINCT InvoiceNo) FILTER (IsRevenueEligible) AS SalesOrders,
  count(DISTINCT InvoiceNo) FILTER (IsReturn) AS ReturnOrders,
  coalesce(sum(LineRevenue) FILTER (IsRevenueEligible), 0) AS Gross,
  coalesce(sum(LineRevenue) FILTER (IsReturn), 0) AS Ret,
  sum(LineRevenue) AS NetAll,
  coalesce(sum(Quantity) FILTER (IsRevenueEligible), 0)::BIGINT AS Units,
  coalesce(sum(Quantity) FILTER (IsReturn), 0)::BIGINT AS RetUnits,
  sum(UnitPrice) FILTER (IsRevenueEligible)::DOUBLE / count(*) FILTER (IsRevenueEligible) AS AvgPrice
FROM x_tx GROUP BY StockCode
"""

TABLES["x_sale_names"] = """
SELECT StockCode, Description FROM (
  SELECT StockCode, Description,
    row_number() OVER (PARTITION BY StockCode ORDER BY count(*) DESC, Description) AS k
  FROM x_tx WHERE IsRevenueEligible AND Description IS NOT NULL GROUP BY StockCode, Description) WHERE k = 1
"""

TABLES["x_first_names"] = """
SELECT StockCode, Description FROM (
  SELECT StockCode, Description,
    row_number() OVER (PARTITION BY StockCode ORDER BY InvoiceDate, InvoiceNo, Description) AS k
  FROM x_tx WHERE Description IS NOT NULL) WHERE k = 1
"""

TABLES["x_rfm_base"] = """
SELECT CustomerID,
  date_diff('day', max(InvoiceDate)::DATE, (SELECT max(InvoiceDate)::DATE + 1 FROM x_tx
    WHERE IsRevenueEligible AND CustomerID IS NOT NULL)) AS Recency,
  count(DISTINCT InvoiceNo) AS Frequency, sum(LineRevenue) AS Monetary, sum(Quantity)::BIGINT AS TotalUnits,
  min(InvoiceDate) AS FirstPurchase, max(InvoiceDate) AS LastPurchase,
  date_diff('day', min(InvoiceDate)::DATE, max(InvoiceDate)::DATE) AS CustomerLifetimeDays
FROM x_tx WHERE IsRevenueEligible AND CustomerID IS NOT NULL GROUP BY CustomerID
"""

TABLES["x_rfm_scored"] = """
SELECT * EXCLUDE (fr, mr, n, edges), Monetary::DOUBLE / nullif(Frequency, 0) AS AverageOrderValue,
  5 - (CASE WHEN Recency > edges[1] THEN 1 ELSE 0 END + CASE WHEN Recency > edges[2] THEN 1 ELSE 0 END
     + CASE WHEN Recency > edges[3] THEN 1 ELSE 0 END + CASE WHEN Recency > edges[4] THEN 1 ELSE 0 END)::BIGINT AS R_Score,
  greatest(1, (5 * (fr - 1) + n - 2) // (n - 1))::BIGINT AS F_Score,
  greatest(1, (5 * (mr - 1) + n - 2) // (n - 1))::BIGINT AS M_Score
FROM (
  SELECT *, row_number() OVER (ORDER BY Frequency, CustomerID) AS fr,
    row_number() OVER (ORDER BY Monetary, CustomerID) AS mr, count(*) OVER () AS n,
    (SELECT quantile_cont(Recency, [0.2, 0.4, 0.6, 0.8]) FROM x_rfm_base) AS edges
  FROM x_rfm_base)
"""

TABLES["x_rfm"] = """
SELECT *, R_Score::VARCHAR || F_Score::VARCHAR || M_Score::VARCHAR AS RFM_Score,
  R_Score + F_Score + M_Score AS RFM_Total,
  CASE WHEN R_Score >= 4 THEN CASE WHEN F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
                                   WHEN F_Score >= 3 THEN 'Loyal Customers' ELSE 'New / Promising' END
       WHEN R_Score = 3 THEN CASE WHEN F_Score >= 3 THEN 'Potential Loyalists' ELSE 'Needs Attention' END
       WHEN F_Score >= 4 AND M_Score >= 4 THEN 'At Risk High Value'
       WHEN F_Score >= 3 THEN 'At Risk' ELSE 'Hibernating' END AS Segment
FROM x_rfm_scored
"""

TABLES["x_value"] = """
SELECT c.CustomerID, Gross AS GrossRevenue, SalesOrders, Units AS UnitsSold, Ret AS ReturnValue, ReturnOrders,
  abs(RetUnits) AS ReturnedUnits, Gross + Ret AS NetRevenue, ReturnOrders::DOUBLE / nullif(SalesOrders, 0) AS ReturnRate,
  abs(Ret)::DOUBLE / Gross::DOUBLE AS ReturnValueRate, Recency, Frequency, Monetary, Segment, CustomerLifetimeDays,
  AverageOrderValue,
  sum(Gross + Ret) OVER (ORDER BY Gross + Ret DESC, c.CustomerID ROWS UNBOUNDED PRECEDING) AS CumulativeNetRevenue,
  sum(Gross + Ret) OVER (ORDER BY Gross + Ret DESC, c.CustomerID ROWS UNBOUNDED PRECEDING)::DOUBLE
    / (sum(Gross + Ret) OVER ())::DOUBLE * 100 AS CumulativeRevenuePct,
  row_number() OVER (ORDER BY Gross + Ret DESC, c.CustomerID) AS RevenueRank
FROM x_cust c LEFT JOIN x_rfm r ON c.CustomerID = r.CustomerID WHERE SaleLines > 0
"""

TABLES["x_risk"] = """
SELECT *, CASE WHEN ValueTier = 'Very High Value' AND ReturnRisk IN ('High Return Risk', 'Very High Return Risk')
            THEN 'High Value / High Return Risk'
          WHEN ValueTier = 'Very High Value' THEN 'Strategic High Value'
          WHEN ValueTier = 'High Value' AND ReturnRisk IN ('High Return Risk', 'Very High Return Risk')
            THEN 'High Value / Return Risk'
          WHEN ReturnRisk = 'Very High Return Risk' THEN 'Severe Return Risk' ELSE 'Standard' END AS StrategicClass
FROM (
  SELECT * EXCLUDE (k, n),
    (['Low Value', 'Mid Value', 'High Value', 'Very High Value'])[greatest(1, (4 * (k - 1) + n - 2) // (n - 1))] AS ValueTier,
    CASE WHEN ReturnValueRate = 0 THEN 'No Returns' WHEN ReturnValueRate < 0.05 THEN 'Low Return Risk'
         WHEN ReturnValueRate < 0.15 THEN 'Moderate Return Risk' WHEN ReturnValueRate < 0.3 THEN 'High Return Risk'
         ELSE 'Very High Return Risk' END AS ReturnRisk
  FROM (SELECT *, row_number() OVER (ORDER BY NetRevenue, CustomerID) AS k, count(*) OVER () AS n FROM x_value))
"""

TABLES["x_cohort"] = """
SELECT CohortMonth, CohortIndex, ActiveCustomers, CohortSize,
  ActiveCustomers::DOUBLE / CohortSize * 100 AS RetentionRate, Revenue
FROM (
  SELECT CohortMonth, date_diff('month', CohortMonth, PurchaseMonth) + 1 AS CohortIndex,
    count(DISTINCT CustomerID) AS ActiveCustomers, sum(LineRevenue)::DOUBLE AS Revenue
  FROM (SELECT t.CustomerID, date_trunc('month', InvoiceDate) AS PurchaseMonth, CohortMonth, LineRevenue
        FROM x_tx t JOIN (SELECT CustomerID, date_trunc('month', min(InvoiceDate)) AS CohortMonth FROM x_tx
          WHERE IsRevenueEligible AND CustomerID IS NOT NULL GROUP BY 1) f ON t.CustomerID = f.CustomerID
        WHERE IsRevenueEligible)
  GROUP BY ALL) a
JOIN (SELECT date_trunc('month', first_sale) AS CohortMonth, count(*) AS CohortSize
      FROM (SELECT CustomerID, min(InvoiceDate) AS first_sale FROM x_tx
            WHERE IsRevenueEligible AND CustomerID IS NOT NULL GROUP BY 1) GROUP BY 1) s USING (CohortMonth)
"""

TABLES["x_intel"] = """
SELECT p.StockCode, Gross AS GrossRevenue, Units AS UnitsSold, SalesLines, SalesOrders, AvgPrice AS AvgUnitPrice,
  Description, Ret AS ReturnValue, abs(RetUnits) AS ReturnedUnits, ReturnLines, ReturnOrders,
  Gross + Ret AS NetRevenue, abs(Ret)::DOUBLE / Gross::DOUBLE AS ReturnValueRate,
  abs(RetUnits)::DOUBLE / Units AS ReturnUnitRate, Gross::DOUBLE / Units AS RevenuePerUnit,
  Gross::DOUBLE / SalesOrders AS RevenuePerOrder,
  (Gross + Ret)::DOUBLE / (sum(Gross + Ret) OVER ())::DOUBLE * 100 AS RevenueShare,
  row_number() OVER (ORDER BY Gross + Ret DESC, p.StockCode) AS RevenueRank
FROM x_prod p LEFT JOIN x_sale_names d ON p.StockCode = d.StockCode WHERE SaleLines > 0
"""

TABLES["x_tax"] = f"""
SELECT *, ProductCategory = 'Merchandise' AS CommercialProduct,
  GrossRevenue::DOUBLE / (sum(GrossRevenue) OVER ())::DOUBLE * 100 AS RevenueShare
FROM (
  SELECT p.StockCode, Gross AS GrossRevenue, Units AS UnitsSold, SalesLines, SalesOrders, Description,
    CASE WHEN upper(p.StockCode) IN ('M', 'AMAZONFEE', 'BANK CHARGES', 'D') THEN 'Fees / Adjustments'
         WHEN upper(p.StockCode) IN ('POST', 'DOT') THEN 'Logistics / Postage'
         WHEN upper(p.StockCode) = 'S' OR upper(coalesce(Description, '')) LIKE '%SAMPLE%' THEN 'Samples'
         WHEN upper(coalesce(Description, '')) LIKE '%MANUAL%' THEN 'Fees / Adjustments'
         ELSE 'Merchandise' END AS ProductCategory
  FROM x_prod p LEFT JOIN x_sale_names d ON p.StockCode = d.StockCode WHERE SaleLines > 0)
"""

# Score: exact integer arithmetic, rounded half up at four digits.
TABLES["x_quality"] = f"""
SELECT * EXCLUDE (nr2, ur2, n),
  ((7 * nr2 + 3 * ur2)::HUGEINT * 20000 + 20 * n) // (40 * n) / 10000.0::DOUBLE AS CommercialPerformanceScore,
  CASE WHEN CommercialValidity = 'Valid' AND NetRevenue > 0 AND ReturnValueRate < 0.05 THEN 'Core Commercial Product'
       WHEN CommercialValidity = 'Valid' AND NetRevenue > 0 AND ReturnValueRate < 0.15 THEN 'Monitor Return Risk'
       WHEN CommercialValidity = 'Valid' AND NetRevenue > 0 AND ReturnValueRate >= 0.15 THEN 'High Return Risk'
       ELSE 'Review / Operational' END AS StrategicClassification
FROM (
  SELECT *, CASE WHEN DescriptionQualityFlag = 'Commercial Description' THEN 'Valid' ELSE 'Review Required' END AS CommercialValidity,
    CASE WHEN ReturnValueRate <= 0.05 THEN 'Low' WHEN ReturnValueRate <= 0.15 THEN 'Moderate'
         WHEN ReturnValueRate <= 0.3 THEN 'High' WHEN ReturnValueRate IS NOT NULL THEN 'Very High' END AS ReturnRisk,
    2 * rank() OVER (ORDER BY NetRevenue) + count(*) OVER (PARTITION BY NetRevenue) - 1 AS nr2,
    2 * rank() OVER (ORDER BY UnitsSold) + count(*) OVER (PARTITION BY UnitsSold) - 1 AS ur2,
    count(*) OVER () AS n
  FROM (
    SELECT *, CASE WHEN Description = '' THEN 'Missing Description'
      WHEN regexp_matches(lower(Description), '{"|".join(C.QUALITY_KEYWORDS)}') THEN 'Operational / Dirty Description'
      ELSE 'Commercial Description' END AS DescriptionQualityFlag
    FROM (SELECT p.StockCode, trim(coalesce(d.Description, '')) AS Description, Gross AS GrossRevenue,
            NetAll AS NetRevenue, Units AS UnitsSold, Lines AS SalesLines, Orders, Ret AS ReturnValue,
            abs(RetUnits) AS ReturnedUnits,
            CASE WHEN Gross > 0 THEN round(abs(Ret)::DOUBLE / Gross::DOUBLE, 4) END AS ReturnValueRate
          FROM x_prod p LEFT JOIN x_first_names d ON p.StockCode IS NOT DISTINCT FROM d.StockCode)))
"""

_TOP, _HIGH, _MID = S.product_tiers

TABLES["x_master"] = f"""
SELECT *, CASE WHEN ProductMasterStatus <> '{C.VALIDATED}' THEN 'Not Applicable'
    WHEN NetRevenue > {_TOP} THEN 'Tier 1 - Strategic' WHEN NetRevenue > {_HIGH} THEN 'Tier 2 - High Value'
    WHEN NetRevenue > {_MID} THEN 'Tier 3 - Established' ELSE 'Tier 4 - Long Tail' END AS CommercialPriority,
  CASE WHEN ProductMasterStatus <> '{C.VALIDATED}' THEN 'Low / Not Applicable' WHEN ReturnValueRate >= 0.3 THEN 'Critical'
    WHEN ReturnValueRate >= 0.15 THEN 'High' WHEN ReturnValueRate >= 0.05 THEN 'Moderate'
    ELSE 'Low / Not Applicable' END AS ReturnRiskFlag,
  ProductMasterStatus = '{C.VALIDATED}' AS IncludeInExecutiveAnalytics
FROM (
  SELECT *, CASE WHEN IsOperationalRecord THEN 'Operational / Adjustment'
      WHEN IsMissingDescription AND NOT HasCommercialActivity THEN 'Inactive / Unmapped'
      WHEN IsMissingDescription THEN 'Master Data Incomplete'
      WHEN NOT HasCommercialActivity THEN 'Inactive / No Activity' ELSE '{C.VALIDATED}' END AS ProductMasterStatus
  FROM (SELECT * REPLACE (coalesce(ReturnValueRate, 0) AS ReturnValueRate),
          regexp_matches(lower(Description), '{"|".join(C.MASTER_KEYWORDS)}') AS IsOperationalRecord,
          Description = '' AS IsMissingDescription,
          GrossRevenue > 0 OR UnitsSold > 0 OR Orders > 0 AS HasCommercialActivity
        FROM x_quality))
"""

TABLES["x_scope"] = f"""
SELECT * EXCLUDE (k, total),
  CASE WHEN IsCommercialMerchandise THEN 'Included' ELSE 'Excluded' END AS ExecutiveScope,
  CASE WHEN IsCommercialMerchandise THEN 'Included'
       WHEN ProductMasterStatus = 'Operational / Adjustment' THEN 'Operational / Adjustment'
       WHEN ProductMasterStatus = 'Master Data Incomplete' THEN 'Missing Product Master Data'
       WHEN IsNonMerchandise THEN 'Non-Merchandise / Logistics / Fee' ELSE 'Other Review' END AS ScopeReason,
  CASE WHEN IsCommercialMerchandise THEN NetRevenue::DOUBLE / total ELSE 0 END AS RevenueShare,
  CASE WHEN IsCommercialMerchandise THEN k ELSE 0 END AS RevenueRank,
  CASE WHEN NOT IsCommercialMerchandise THEN 'Not Applicable' WHEN NetRevenue <= {_MID} THEN 'Tier 4 - Long Tail'
       WHEN NetRevenue <= {_HIGH} THEN 'Tier 3 - Established' WHEN NetRevenue <= {_TOP} THEN 'Tier 2 - High Value'
       ELSE 'Tier 1 - Strategic' END AS ExecutiveProductTier
FROM (
  SELECT *, row_number() OVER (PARTITION BY IsCommercialMerchandise ORDER BY NetRevenue DESC, StockCode) AS k,
    (sum(NetRevenue) OVER (PARTITION BY IsCommercialMerchandise))::DOUBLE AS total
  FROM (SELECT *, ProductMasterStatus = '{C.VALIDATED}' AND NOT IsNonMerchandise AS IsCommercialMerchandise
        FROM (SELECT *, StockCode IN ({texts(C.NON_MERCHANDISE_CODES)}) AS IsNonMerchandise FROM x_master)))
"""

TABLES["x_anomaly"] = f"""
SELECT *, CASE WHEN AnomalySeverity = 'Critical Review' THEN 'Validate product master and transaction history'
    WHEN AnomalySeverity = 'High Review' THEN 'Investigate before executive reporting'
    WHEN DescriptionAnomaly THEN 'Validate product description / SKU mapping'
    WHEN ReturnAnomaly THEN 'Investigate return behaviour' ELSE 'No immediate action' END AS RecommendedAction
FROM (
  SELECT *, CASE WHEN AnomalyScore >= 3 THEN 'Critical Review' WHEN AnomalyScore = 2 THEN 'High Review'
                 WHEN AnomalyScore = 1 THEN 'Monitor' ELSE 'Normal' END AS AnomalySeverity
  FROM (
    SELECT *, DescriptionAnomaly::BIGINT + ReturnAnomaly::BIGINT + HighRevenueAnomaly::BIGINT
      + HighVolumeLowValueAnomaly::BIGINT + ExtremeRevenuePerOrder::BIGINT + ExtremeRevenuePerUnit::BIGINT AS AnomalyScore
    FROM (
      SELECT * EXCLUDE (p_net, p_units, p_order, p_unit), ReturnValueRate >= 0.3 AS ReturnAnomaly,
        NetRevenue::DOUBLE >= p_net AND DescriptionAnomaly AS HighRevenueAnomaly,
        UnitsSold::DOUBLE >= p_units AND NetRevenue <= 0 AS HighVolumeLowValueAnomaly,
        RevenuePerOrder >= p_order AS ExtremeRevenuePerOrder, RevenuePerUnit >= p_unit AS ExtremeRevenuePerUnit
      FROM (SELECT *, quantile_cont(NetRevenue::DOUBLE, 0.95) OVER () AS p_net,
              quantile_cont(UnitsSold::DOUBLE, 0.95) OVER () AS p_units,
              quantile_cont(RevenuePerOrder, 0.99) OVER () AS p_order,
              quantile_cont(RevenuePerUnit, 0.99) OVER () AS p_unit
            FROM (SELECT *, CASE WHEN Orders > 0 THEN NetRevenue::DOUBLE / Orders ELSE 0 END AS RevenuePerOrder,
                    CASE WHEN UnitsSold > 0 THEN NetRevenue::DOUBLE / UnitsSold ELSE 0 END AS RevenuePerUnit,
                    regexp_matches(lower(Description), '{"|".join(C.ANOMALY_KEYWORDS)}') AS DescriptionAnomaly
                  FROM x_scope WHERE IsCommercialMerchandise)))))
"""


def _members(item: str) -> str:
    return f"""
SELECT DISTINCT t.InvoiceNo, t.{item} AS Item FROM x_tx t JOIN x_tax p ON t.StockCode = p.StockCode
WHERE CommercialProduct AND IsRevenueEligible AND t.InvoiceNo NOT LIKE 'C%' AND t.{item} IS NOT NULL
"""


def _basket(members: str) -> str:
    return f"""
SELECT InvoiceNo, Item FROM (SELECT *, count(*) OVER (PARTITION BY InvoiceNo) AS size FROM {members}) WHERE size >= 2
"""


def _pairs(basket: str, threshold: int, name: str) -> str:
    return f"""
SELECT p.ProductA, p.ProductB, PairOrders, PairOrders::DOUBLE / n AS Support, a.c AS ProductAOrders,
  b.c AS ProductBOrders, PairOrders::DOUBLE / a.c AS Confidence_A_to_B, PairOrders::DOUBLE / b.c AS Confidence_B_to_A,
  (PairOrders * n)::DOUBLE / (a.c * b.c)::DOUBLE AS Lift, {name.format("A")} AS ProductA_Description,
  {name.format("B")} AS ProductB_Description
FROM (SELECT l.Item AS ProductA, r.Item AS ProductB, count(*) AS PairOrders
      FROM {basket} l JOIN {basket} r ON l.InvoiceNo = r.InvoiceNo AND l.Item < r.Item
      GROUP BY ALL HAVING count(*) >= {threshold}) p
JOIN (SELECT Item, count(*) AS c FROM {basket} GROUP BY Item) a ON p.ProductA = a.Item
JOIN (SELECT Item, count(*) AS c FROM {basket} GROUP BY Item) b ON p.ProductB = b.Item
CROSS JOIN (SELECT count(DISTINCT InvoiceNo) AS n FROM {basket})
"""


TABLES["x_members"] = _members(S.basket_item)
TABLES["x_members_code"] = _members("StockCode")
TABLES["x_basket"] = _basket("x_members")
TABLES["x_basket_code"] = _basket("x_members_code")
TABLES["x_assoc"] = _pairs("x_basket", S.min_pair_orders, "p.Product{}")
TABLES["x_assoc_code"] = _pairs(
    "x_basket_code", 3, "(SELECT Description FROM x_tax WHERE x_tax.StockCode = p.Product{})"
)

_V = S.vocabulary
_COMPLEMENTARY = " OR ".join(f"(contains(a, '{x}') AND contains(b, '{y}'))" for x, y in _V.complementary)


def _scored(pairs: str, orders: int) -> str:
    return f"""
SELECT * EXCLUDE (a, b), ln(1 + PairOrders::DOUBLE) * ln(1 + Lift) * Confidence_A_to_B
    * CASE AssociationType WHEN 'Complementary Cross-Sell' THEN 1.35::DOUBLE WHEN 'Coordinated Set' THEN 1.2::DOUBLE
        WHEN 'Cross-Sell' THEN 1.0::DOUBLE ELSE 0.75::DOUBLE END AS ExecutiveScore
FROM (
  SELECT *, CASE WHEN {_COMPLEMENTARY} THEN 'Complementary Cross-Sell'
      WHEN {any_of("a", _V.coordinated)} AND {any_of("b", _V.coordinated)} THEN 'Coordinated Set'
      WHEN {any_of("a", _V.family)} AND {any_of("b", _V.family)} THEN 'Variant / Product Family'
      ELSE 'Cross-Sell' END AS AssociationType
  FROM (SELECT *, upper(coalesce(ProductA_Description, '')) AS a, upper(coalesce(ProductB_Description, '')) AS b
        FROM {pairs} WHERE PairOrders >= {orders} AND Lift >= {S.cross_sell_lift}
          AND Confidence_A_to_B >= {S.cross_sell_confidence}))
"""


def _cross(scored: str) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY ExecutiveScore DESC, PairOrders DESC, Lift DESC, ProductA, ProductB) AS ExecutiveRank,
  ProductA, ProductA_Description, ProductB, ProductB_Description, AssociationType,
  CASE AssociationType WHEN 'Complementary Cross-Sell' THEN 'Accessory / Complementary Recommendation'
    WHEN 'Coordinated Set' THEN 'Bundle / Set Recommendation' ELSE 'Cross-Sell Recommendation' END AS CommercialAction,
  PairOrders, Support, Confidence_A_to_B, Confidence_B_to_A, Lift, ExecutiveScore,
  CASE AssociationType
    WHEN 'Complementary Cross-Sell' THEN '{C.ADVICE[C.COMPLEMENTARY]}'
    WHEN 'Coordinated Set' THEN '{C.ADVICE[C.COORDINATED]}' ELSE '{C.DEFAULT_ADVICE}' END AS BusinessRecommendation
FROM {scored} WHERE AssociationType <> 'Variant / Product Family'
ORDER BY 1 LIMIT {S.cross_sell_top}
"""


TABLES["x_scored"] = _scored("x_assoc", S.cross_sell_orders)
TABLES["x_scored_code"] = _scored("x_assoc_code", 3)
TABLES["x_cross"] = _cross("x_scored")
TABLES["x_cross_code"] = _cross("x_scored_code")
