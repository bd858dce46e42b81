"""The churn table as SQL, shared by the oracle queries."""

BASE = """
past AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01 00:00:00' GROUP BY o_custkey
), last_seen AS (
  SELECT o_custkey, o_orderpriority AS last_priority FROM (
    SELECT o_custkey, o_orderpriority,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01 00:00:00') AS ranked_orders
  WHERE rn = 1
), recent AS (
  SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-08-01 00:00:00'
                AND o_orderdate < TIMESTAMP '2000-08-01 00:00:00' GROUP BY o_custkey
), bought AS (
  SELECT o_custkey, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
         max(CASE WHEN p_type = 'STANDARD' THEN 1 ELSE 0 END) AS b1,
         max(CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END) AS b2,
         max(CASE WHEN p_type = 'MEDIUM' THEN 1 ELSE 0 END) AS b3,
         max(CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END) AS b4,
         max(CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END) AS b5,
         max(CASE WHEN p_type = 'LARGE' THEN 1 ELSE 0 END) AS b6
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
  WHERE o_orderdate >= TIMESTAMP '1999-08-01 00:00:00'
    AND o_orderdate < TIMESTAMP '2000-08-01 00:00:00' GROUP BY o_custkey
), later AS (
  SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01 00:00:00'
), users AS (
  SELECT DISTINCT user_id FROM events
), joined AS (
  SELECT c_custkey AS k, c_acctbal, c_mktsegment, n_regionkey, past.total,
         (year(last_order) * 12 + month(last_order)) - (year(first_order) * 12 + month(first_order)) AS months,
         last_priority, coalesce(recent.n, 0) AS n_recent, recent.total AS recent_total,
         coalesce(returned, 0) AS returned, coalesce(b1, 0) AS b1, coalesce(b2, 0) AS b2,
         coalesce(b3, 0) AS b3, coalesce(b4, 0) AS b4, coalesce(b5, 0) AS b5, coalesce(b6, 0) AS b6,
         user_id, later.o_custkey AS later_key
  FROM customer JOIN past ON past.o_custkey = c_custkey
  JOIN last_seen ON last_seen.o_custkey = c_custkey
  LEFT JOIN recent ON recent.o_custkey = c_custkey
  LEFT JOIN bought ON bought.o_custkey = c_custkey
  LEFT JOIN later ON later.o_custkey = c_custkey
  LEFT JOIN users ON user_id = c_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
), base AS (
  SELECT CAST(k AS VARCHAR) AS "customerID",
    CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS "SeniorCitizen",
    CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
    CASE WHEN returned = 1 THEN 'Yes' ELSE 'No' END AS "Dependents",
    CAST(months AS INTEGER) AS tenure,
    CASE WHEN n_regionkey = 0 THEN 'No' ELSE 'Yes' END AS "PhoneService",
    CASE WHEN n_regionkey = 0 THEN 'No phone service' WHEN n_recent > 1 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
    CASE WHEN n_recent = 0 THEN 'No' WHEN recent_total > n_recent * 250000 THEN 'Fiber optic' ELSE 'DSL' END AS "InternetService",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b1 = 1 THEN 'Yes' ELSE 'No' END AS "OnlineSecurity",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b2 = 1 THEN 'Yes' ELSE 'No' END AS "OnlineBackup",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b3 = 1 THEN 'Yes' ELSE 'No' END AS "DeviceProtection",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b4 = 1 THEN 'Yes' ELSE 'No' END AS "TechSupport",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b5 = 1 THEN 'Yes' ELSE 'No' END AS "StreamingTV",
    CASE WHEN n_recent = 0 THEN 'No internet service' WHEN b6 = 1 THEN 'Yes' ELSE 'No' END AS "StreamingMovies",
    CASE WHEN last_priority IN ('1-URGENT', '2-HIGH') THEN 'Month-to-month'
         WHEN last_priority = '5-LOW' THEN 'Two year' ELSE 'One year' END AS "Contract",
    CASE WHEN user_id IS NOT NULL THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Electronic check' WHEN 'BUILDING' THEN 'Mailed check'
         WHEN 'FURNITURE' THEN 'Bank transfer' ELSE 'Credit card' END AS "PaymentMethod",
    (CAST(total * 100 AS BIGINT) // (months + 1)) / 100.0::DOUBLE AS "MonthlyCharges",
    CASE WHEN months = 0 OR k % 50 = 7 THEN ' ' ELSE CAST(total AS VARCHAR) END AS "TotalCharges",
    CASE WHEN later_key IS NULL THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM joined
)"""


def over_base(query: str, *ctes: str) -> str:
    """`query` over the churn table `base`, with further common table expressions."""
    return "WITH " + ",\n".join([BASE.strip(), *[c.strip() for c in ctes]]) + "\n" + query.strip()
