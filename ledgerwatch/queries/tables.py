"""Feature, label and training tables, keyed writes and the point-in-time join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.risk import RISK_SCORE
from ledgerwatch.operators import keyed
from ledgerwatch.operators.asof import asof_join
from ledgerwatch.operators.sampling import hash_sample, hash_top_n
from ledgerwatch.plans import features
from ledgerwatch.plans.oracles import over
from ledgerwatch.plans.registry import query
from ledgerwatch.sources.binding import Bank
from ledgerwatch.sources.tables import staged

KEYS = ["transaction_id", "event_ts"]
SCORED_AT = "2024-01-01 12:00:00"


def _before(day: str):
    return F.col("event_ts") < F.lit(day).cast("timestamp_ntz")


@query(over("fraud_features", select="SELECT * FROM fraud_features"))
def fraud_features(bank: Bank) -> DataFrame:
    return bank.features


@query(over("fraud_scored", select="SELECT transaction_id, risk_score FROM fraud_scored"))
def risk_score(bank: Bank) -> DataFrame:
    return RISK_SCORE.add_to(features.with_features(bank.gold)).select("transaction_id", "risk_score")


@query(over("fraud_labels", select="SELECT * FROM fraud_labels"))
def label_table(bank: Bank) -> DataFrame:
    return features.label_table(bank.gold)


@query(over("fraud_labels", select="SELECT is_fraud, split, count(*) AS n FROM fraud_labels GROUP BY ALL"))
def label_split_counts(bank: Bank) -> DataFrame:
    return features.label_table(bank.gold).groupBy("is_fraud", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    over(
        "fraud_scored",
        "fraud_labels",
        select="""SELECT l.split, s.* EXCLUDE (prediction, model_version, label), s.label AS is_fraud
                  FROM fraud_scored s JOIN fraud_labels l USING (transaction_id)""",
    )
)
def training_set(bank: Bank) -> DataFrame:
    gold = bank.stored_gold()
    return features.training_set(features.label_table(gold), features.feature_table(gold), unique=True)


@query(
    over(
        "fraud_scored",
        select=f"""SELECT transaction_id, event_ts, label AS is_fraud, amount, risk_score,
                   CAST(prediction AS DOUBLE) AS prediction, '1' AS model_version,
                   TIMESTAMP '{SCORED_AT}' AS inference_timestamp FROM fraud_scored""",
    )
)
def inference_log(bank: Bank) -> DataFrame:
    gold = bank.stored_gold()
    joined = features.training_set(features.label_table(gold), features.feature_table(gold), unique=True)
    scored = joined.select(
        *KEYS,
        "is_fraud",
        "split",
        "amount",
        "risk_score",
        features.rule_prediction(F.col("risk_score")).cast("double").alias("prediction"),
    )
    return features.inference_log(scored, F.lit("1"), F.lit(SCORED_AT).cast("timestamp_ntz"))


@query(
    over(
        "fraud_scored",
        "fraud_labels",
        select="""SELECT s.transaction_id, s.event_ts, s.prediction, s.model_version,
                  CAST(l.is_fraud AS DOUBLE) AS label
                  FROM fraud_scored s LEFT JOIN fraud_labels l
                  ON s.transaction_id = l.transaction_id AND s.event_ts = l.event_ts AND l.split = 'train'""",
    )
)
def inference_labelled(bank: Bank) -> DataFrame:
    # Only the training labels have arrived; the other rows keep a null label.
    gold = bank.stored_gold()
    log = features.rule_scored(gold).select(*KEYS, "prediction", "model_version")
    return features.with_labels(log, features.label_table(gold).where("split = 'train'"))


@query(
    over(
        "fraud_scored",
        "fraud_labels",
        select="""SELECT s.transaction_id, s.event_ts, s.prediction,
                  CASE WHEN l.transaction_id IS NULL THEN -1 ELSE l.is_fraud END AS label
                  FROM fraud_scored s LEFT JOIN fraud_labels l
                  ON s.transaction_id = l.transaction_id AND s.event_ts = l.event_ts AND l.split = 'test'""",
    )
)
def label_backfill(bank: Bank) -> DataFrame:
    gold = bank.stored_gold()
    log = features.rule_scored(gold).select(*KEYS, "prediction", F.lit(-1).alias("label"))
    late = features.label_table(gold).where("split = 'test'").withColumnRenamed("is_fraud", "label")
    return keyed.update_from(log, late, KEYS, ["label"])


def _target_and_source(bank: Bank) -> tuple[DataFrame, DataFrame]:
    """Features up to 2000 as stored, and those from 1999 on with an amount corrected by a fee."""
    rows = staged(bank.features.select(*KEYS, "amount", "type", "is_cross_border"), "features")
    stored = rows.where(_before("2000-01-01"))
    newer = rows.where(~_before("1999-01-01")).withColumn(
        "amount", F.when(F.col("is_cross_border") > 0, F.col("amount") + 1).otherwise(F.col("amount"))
    )
    return stored, newer


_VERSIONS = """
old AS (SELECT transaction_id, event_ts, amount, type, is_cross_border FROM fraud_features
        WHERE event_ts < TIMESTAMP '2000-01-01'),
new AS (SELECT transaction_id, event_ts, CASE WHEN is_cross_border > 0 THEN amount + 1 ELSE amount END AS amount,
        type, is_cross_border FROM fraud_features WHERE event_ts >= TIMESTAMP '1999-01-01')"""


@query(
    over(
        "fraud_features",
        ctes=_VERSIONS,
        select="""SELECT * FROM new UNION ALL
                  SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n
                  WHERE n.transaction_id = o.transaction_id AND n.event_ts = o.event_ts)""",
    )
)
def feature_upsert(bank: Bank) -> DataFrame:
    target, source = _target_and_source(bank)
    return keyed.upsert(target, source, KEYS)


@query(
    over(
        "fraud_features",
        ctes=_VERSIONS
        + """, both_sides AS (
  SELECT coalesce(o.transaction_id, n.transaction_id) AS transaction_id, coalesce(o.event_ts, n.event_ts) AS event_ts,
         o.transaction_id IS NOT NULL AS was, n.transaction_id IS NOT NULL AS is_now,
         o.amount AS oa, o.type AS ot, o.is_cross_border AS oc, n.amount AS na, n.type AS nt, n.is_cross_border AS nc
  FROM old o FULL JOIN new n ON o.transaction_id = n.transaction_id AND o.event_ts = n.event_ts)""",
        select="""
SELECT transaction_id, event_ts, 'insert' AS change_type, na AS amount, nt AS type, nc AS is_cross_border
FROM both_sides WHERE NOT was
UNION ALL SELECT transaction_id, event_ts, 'delete', oa, ot, oc FROM both_sides WHERE NOT is_now
UNION ALL SELECT transaction_id, event_ts, 'update_pre', oa, ot, oc FROM both_sides
  WHERE was AND is_now AND (oa, ot, oc) IS DISTINCT FROM (na, nt, nc)
UNION ALL SELECT transaction_id, event_ts, 'update_post', na, nt, nc FROM both_sides
  WHERE was AND is_now AND (oa, ot, oc) IS DISTINCT FROM (na, nt, nc)""",
    )
)
def feature_changes(bank: Bank) -> DataFrame:
    old, new = _target_and_source(bank)
    return keyed.changes(old, new, KEYS)


@query(
    over(
        "gold_transactions",
        select="""SELECT customer_id, event_ts, id, amount, type, oldBalanceOrig, 'v1' AS snapshot_version
                  FROM gold_transactions QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_ts DESC,
                  id DESC, amount DESC, type DESC, oldBalanceOrig DESC) = 1""",
    )
)
def latest_features(bank: Bank) -> DataFrame:
    rows = bank.gold.select("customer_id", "event_ts", "id", "amount", "type", "oldBalanceOrig")
    return keyed.latest_snapshot(rows, "customer_id", "event_ts", F.lit("v1"))


@query(
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                l_returnflag, l_linestatus) = 1"""
)
def dedup_lineitem(bank: Bank) -> DataFrame:
    return keyed.one_per_key(bank.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    over(
        ctes="""clicks AS (SELECT user_id, ts AS click_ts, max(value) AS click_value
                FROM events WHERE event_type = 'click' GROUP BY ALL)""",
        select="""SELECT p.event_id, p.user_id, p.ts, p.value, c.click_value, c.click_ts
                  FROM (SELECT * FROM events WHERE event_type = 'purchase') p
                  ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.click_ts""",
    )
)
def asof_click(bank: Bank) -> DataFrame:
    events = bank.table("events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", F.col("value").alias("click_value"))
    return asof_join(purchases, clicks, on=["user_id"], ts="ts", matched_ts="click_ts")


@query(
    over(
        ctes="""clicks AS (SELECT user_id, ts AS click_ts, max(value) AS click_value
                FROM events WHERE event_type = 'click' GROUP BY ALL),
                found AS (SELECT p.event_id, c.click_value, c.click_ts >= p.ts - INTERVAL 12 HOURS AS recent
                FROM (SELECT * FROM events WHERE event_type = 'purchase') p
                ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.click_ts)""",
        select="SELECT event_id, CASE WHEN recent THEN click_value END AS click_value FROM found",
    )
)
def asof_click_recent(bank: Bank) -> DataFrame:
    """The same with a tolerance, every key on the path for hot keys."""
    events = bank.table("events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", F.col("value").alias("click_value"))
    found = asof_join(
        purchases, clicks, on=["user_id"], ts="ts", tolerance="12 hours", hot_rows=0, range_rows=1000
    )
    return found.select("event_id", "click_value")


@query(
    over(
        "fraud_features",
        select="""SELECT transaction_id, amount FROM fraud_features
          WHERE CAST(concat('0x', substr(md5(concat('sample', transaction_id)), 1, 8)) AS BIGINT) % 100 < 5""",
    ),
    name="hash_sample",
)
def hash_sample_rows(bank: Bank) -> DataFrame:
    return hash_sample(features.with_features(bank.gold).select("transaction_id", "amount"), "transaction_id", 5)


@query(
    over(
        "fraud_features",
        select="""SELECT transaction_id, amount FROM fraud_features
                  ORDER BY md5(concat('sample', transaction_id)), transaction_id LIMIT 2000""",
    ),
    name="hash_top_n",
)
def hash_top_rows(bank: Bank) -> DataFrame:
    return hash_top_n(features.with_features(bank.gold).select("transaction_id", "amount"), "transaction_id", 2000)
