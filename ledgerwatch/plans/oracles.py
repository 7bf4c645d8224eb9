"""The bank tables as SQL common table expressions, for checks on a second engine."""

from __future__ import annotations

VIEWS = {
    "country_coordinates": """
SELECT concat('N', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS alpha3_code, n_name AS country,
       CAST(n_nationkey * 14 - 170 AS DOUBLE) AS long_avg, CAST(n_nationkey * 7 - 84 AS DOUBLE) AS lat_avg
FROM nation""",
    "banking_customers": """
SELECT CAST(c_custkey AS STRING) AS id, c_name AS firstname, c_mktsegment AS lastname,
       concat('N', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS country,
       CAST(c_custkey % 10 AS DOUBLE) AS age_group
FROM customer""",
    "fraud_reports": """
SELECT DISTINCT CAST(l_orderkey AS STRING) AS id, '1' AS is_fraud
FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49""",
    "bronze_transactions": """
SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS customer_id,
       CAST((year(o_orderdate) - 1995) * 372 + (month(o_orderdate) - 1) * 31 + day(o_orderdate) AS BIGINT) AS step,
       o_totalprice AS amount, o_orderpriority AS type,
       concat('C', CAST(o_custkey AS STRING)) AS nameOrig, 'S' || CAST(suppkey AS STRING) AS nameDest,
       c_acctbal * 50 AS oldBalanceOrig,
       greatest(c_acctbal * 50 - o_totalprice, CAST(0 AS DOUBLE)) AS newBalanceOrig,
       CASE WHEN s_acctbal > 0 THEN s_acctbal * 50 ELSE CAST(0 AS DOUBLE) END AS oldBalanceDest,
       CASE WHEN s_acctbal > 0 THEN s_acctbal * 50 ELSE CAST(0 AS DOUBLE) END + o_totalprice AS newBalanceDest,
       concat('N--', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS countryOrig,
       'N--' || lpad(CAST(s_nationkey AS STRING), 2, '0') AS countryDest,
       CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS isUnauthorizedOverdraft,
       o_orderdate AS event_ts
FROM orders JOIN customer ON o_custkey = c_custkey
     LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS suppkey FROM lineitem GROUP BY l_orderkey) dst
            ON l_orderkey = o_orderkey
     LEFT JOIN supplier ON s_suppkey = suppkey""",
    "silver_transactions": """
SELECT t.id, customer_id, step, amount, type, nameOrig, nameDest, oldBalanceOrig, newBalanceOrig,
       oldBalanceDest, newBalanceDest, isUnauthorizedOverdraft, event_ts, is_fraud,
       replace(countryOrig, '--', '') AS countryOrig, replace(countryDest, '--', '') AS countryDest,
       newBalanceOrig - oldBalanceOrig AS diffOrig, newBalanceDest - oldBalanceDest AS diffDest
FROM bronze_transactions t LEFT JOIN fraud_reports f ON t.id = f.id""",
    "gold_transactions": """
SELECT t.id, customer_id, step, amount, type, nameOrig, nameDest, oldBalanceOrig, newBalanceOrig,
       oldBalanceDest, newBalanceDest, isUnauthorizedOverdraft, event_ts, diffOrig, diffDest,
       c.firstname, c.lastname, c.country, c.age_group,
       CAST(coalesce(CAST(is_fraud AS INT), 0) AS BOOLEAN) AS is_fraud,
       o.alpha3_code AS countryOrig, o.country AS countryOrig_name,
       o.long_avg AS countryLongOrig_long, o.lat_avg AS countryLatOrig_lat,
       d.alpha3_code AS countryDest, d.country AS countryDest_name,
       d.long_avg AS countryLongDest_long, d.lat_avg AS countryLatDest_lat
FROM silver_transactions t
     JOIN country_coordinates o ON t.countryOrig = o.alpha3_code
     JOIN country_coordinates d ON t.countryDest = d.alpha3_code
     JOIN banking_customers c ON c.id = t.customer_id""",
    "fraud_features": """
SELECT id AS transaction_id, event_ts, step, amount, type, oldBalanceOrig, newBalanceOrig, oldBalanceDest,
       newBalanceDest, diffOrig, diffDest, age_group, country,
       CAST(isUnauthorizedOverdraft AS DOUBLE) AS is_unauthorized_overdraft,
       countryOrig, countryDest, countryOrig_name, countryDest_name, countryLongOrig_long, countryLatOrig_lat,
       countryLongDest_long, countryLatDest_lat,
       CASE WHEN oldBalanceOrig > 0 THEN amount / oldBalanceOrig ELSE CAST(0 AS DOUBLE) END AS balance_orig_ratio,
       CAST(CASE WHEN newBalanceOrig = 0 AND oldBalanceOrig > 0 THEN 1 ELSE 0 END AS DOUBLE) AS is_full_transfer,
       CAST(CASE WHEN countryOrig <> countryDest THEN 1 ELSE 0 END AS DOUBLE) AS is_cross_border,
       CAST(CASE WHEN oldBalanceDest = 0 AND amount > 100000 THEN 1 ELSE 0 END AS DOUBLE) AS dest_balance_anomaly
FROM gold_transactions""",
    "fraud_labels": """
SELECT id AS transaction_id, event_ts, CASE WHEN is_fraud THEN 1 ELSE 0 END AS is_fraud,
       CASE WHEN CAST(concat('0x', substr(md5(id), 1, 8)) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END AS split
FROM gold_transactions""",
    "fraud_scored": """
SELECT f.*, CASE WHEN g.is_fraud THEN 1 ELSE 0 END AS label,
       CASE WHEN risk_score >= CAST(0.6 AS FLOAT) THEN 1 ELSE 0 END AS prediction,
       CASE WHEN CAST(f.transaction_id AS BIGINT) % 2 = 0 THEN '1' ELSE '2' END AS model_version
FROM (SELECT x.*, CAST(
             CAST(CASE WHEN amount > 200000 THEN 0.3 WHEN amount > 100000 THEN 0.15 ELSE 0 END AS DOUBLE)
           + CAST(CASE WHEN is_full_transfer > 0 THEN 0.25 ELSE 0 END AS DOUBLE)
           + CAST(CASE WHEN balance_orig_ratio > 0.9 THEN 0.15 ELSE 0 END AS DOUBLE)
           + CAST(CASE WHEN is_cross_border > 0 THEN 0.1 ELSE 0 END AS DOUBLE) AS FLOAT) AS risk_score
      FROM fraud_features x) f
     JOIN gold_transactions g ON g.id = f.transaction_id""",
}

# What each view reads.
_NEEDS = {
    "silver_transactions": ["bronze_transactions", "fraud_reports"],
    "gold_transactions": ["silver_transactions", "country_coordinates", "banking_customers"],
    "fraud_features": ["gold_transactions"],
    "fraud_labels": ["gold_transactions"],
    "fraud_scored": ["fraud_features", "gold_transactions"],
}


def _closure(names) -> list[str]:
    found: list[str] = []
    for name in names:
        for needed in [*_closure(_NEEDS.get(name, ())), name]:
            if needed not in found:
                found.append(needed)
    return found


def over(*views: str, ctes: str = "", select: str) -> str:
    """`select` with the named views, and further expressions in `ctes`, in front of it."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _closure(views)]
    if ctes:
        parts.append(ctes.strip())
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + select.strip()
