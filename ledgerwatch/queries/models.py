"""Preparation, training, scoring, explanations and streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.risk import RISK_SCORE
from ledgerwatch.operators import gates
from ledgerwatch.operators.metrics import f1
from ledgerwatch.operators.sampling import split_name
from ledgerwatch.plans import attribution, features, layers, learning, portable, trees
from ledgerwatch.plans.oracles import over
from ledgerwatch.plans.registry import query
from ledgerwatch.sources.binding import Bank
from ledgerwatch.sources.readers import convert, with_coordinates
from ledgerwatch.sources.tables import bucketed, scratch, staged
from ledgerwatch.streaming.flows import score_requests
from ledgerwatch.streaming.ingest import StreamTable, append_stream, follow, ingest_files, read_table, run_to_end, write_batch

STARTED_AT = dt.datetime(2024, 1, 1)
NOT_INPUTS = ("transaction_id", "event_ts", "is_fraud", "split")

# One setting per family, moderate in size.
LOGISTIC = learning.Trial(0, "logistic", {"C": 0.5, "tol": 1e-5})
BOOSTED = learning.Trial(1, "gbt", {"trees": 10, "depth": 4, "rate": 0.2, "bins": 32})


def _known_balances(bank: Bank) -> DataFrame:
    """Balances that are not positive count as unknown."""
    gold = bank.stored_gold("id", *_BALANCE_COLUMNS)
    return gold.select("id", *[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in _BALANCE_COLUMNS])


_BALANCES = """known AS (SELECT id, CASE WHEN oldBalanceOrig > 0 THEN oldBalanceOrig END AS oldBalanceOrig,
  CASE WHEN newBalanceOrig > 0 THEN newBalanceOrig END AS newBalanceOrig,
  CASE WHEN oldBalanceDest > 0 THEN oldBalanceDest END AS oldBalanceDest FROM gold_transactions)"""
_BALANCE_COLUMNS = ("oldBalanceOrig", "newBalanceOrig", "oldBalanceDest")


def _rounded(df: DataFrame, columns, digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    over(
        "gold_transactions",
        ctes=_BALANCES,
        select=f"""SELECT id, {", ".join(f"round(coalesce({c}, avg({c}) OVER ()), 3) AS {c}" for c in _BALANCE_COLUMNS)}
                   FROM known""",
    )
)
def imputed(bank: Bank) -> DataFrame:
    return _rounded(learning.impute_mean(_known_balances(bank), _BALANCE_COLUMNS), _BALANCE_COLUMNS, 3)


@query(
    over(
        "gold_transactions",
        ctes=_BALANCES,
        select=f"""SELECT id, {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _BALANCE_COLUMNS)}
                   FROM known""",
    )
)
def standardized(bank: Bank) -> DataFrame:
    return _rounded(learning.standardize(_known_balances(bank), _BALANCE_COLUMNS), _BALANCE_COLUMNS, 6)


_ENCODED = ("type", "country", "countryDest_name")


@query(
    over(
        "fraud_features",
        "fraud_labels",
        ctes="seen AS (SELECT f.* FROM fraud_features f JOIN fraud_labels l USING (transaction_id) WHERE split = 'train')",
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, CASE WHEN {c} IN (SELECT {c} FROM seen) THEN {c} ELSE '(unseen)' END
                AS category, count(*) AS n FROM fraud_features GROUP BY 2"""
            for c in _ENCODED
        ),
    )
)
def onehot_counts(bank: Bank) -> DataFrame:
    rows = features.with_features(bank.gold).select("transaction_id", "amount", *_ENCODED)
    rows = staged(rows.withColumn("split", split_name(F.col("transaction_id"))), "encoded")
    model = learning.preparation(rows.where("split = 'train'"), _ENCODED, ["amount"])
    return learning.onehot_totals(model, rows, _ENCODED)


def _training(bank: Bank) -> DataFrame:
    """The training set as a table: preparation, fit and scoring each read it."""
    gold = bank.stored_gold()
    return staged(features.training_set(features.label_table(gold), features.feature_table(gold), unique=True), "training")


def _train_rows(training: DataFrame) -> DataFrame:
    return training.where("split = 'train'")


def _scored_by(bank: Bank, trial: learning.Trial) -> DataFrame:
    training = _training(bank)
    categorical, numeric = learning.model_columns(training, NOT_INPUTS)
    model = learning.fit(_train_rows(training), trial, categorical, numeric)
    return learning.score(model, training, ["transaction_id", "is_fraud", "split"])


@query()
def trained_logistic(bank: Bank) -> DataFrame:
    return _scored_by(bank, LOGISTIC)


@query()
def trained_gbt(bank: Bank) -> DataFrame:
    return _scored_by(bank, BOOSTED)


# A linear model and a small boosted one as they were stored once: SQL for the inputs, then weights or trees.
_STORED_PLACES = (
    portable.scaled("amount", 180_000.0, 95_000.0), portable.scaled("balance_orig_ratio", 0.85, 2.5), portable.scaled("is_cross_border", 0.96, 0.2),
    portable.scaled("age_group", 4.5, 2.875), portable.is_category("type", "1-URGENT", learning.MISSING), portable.is_category("type", "5-LOW", learning.MISSING),
)
_STORED_LINEAR = portable.Portable(_STORED_PLACES, portable.LOG_ODDS, (0.625, 0.125, 0.0625, -0.25, 0.375, -0.5), -1.125)
_STORED_BOOSTED = portable.Portable(
    _STORED_PLACES,
    portable.LOG_ODDS,
    forest=trees.Forest(
        (
            trees.Node(0, 0, left=1, right=2, place=0, threshold=0.25), trees.Node(0, 1, -0.875), trees.Node(0, 2, left=3, right=4, place=4, values=(0.0,)),
            trees.Node(0, 3, 0.125), trees.Node(0, 4, left=5, right=6, place=3, threshold=-0.5), trees.Node(0, 5, 0.75), trees.Node(0, 6, 0.375),
            trees.Node(1, 0, left=1, right=2, place=1, threshold=0.0), trees.Node(1, 1, left=3, right=4, place=5, values=(1.0,)), trees.Node(1, 2, 0.3125),
            trees.Node(1, 3, -0.4375), trees.Node(1, 4, 0.0625), trees.Node(2, 0, -0.1875),
        ),
        ("amount", "balance_orig_ratio", "is_cross_border", "age_group", "type", "type"),
    ),
)
_SCORED_COLUMNS = ["transaction_id", "is_fraud", "split"]


def _stored_sql(model: portable.Portable) -> str:
    scored = model.sql("labelled", _SCORED_COLUMNS)
    labelled = "labelled AS (SELECT f.*, l.is_fraud, l.split FROM fraud_features f JOIN fraud_labels l USING (transaction_id))"
    return over("fraud_features", "fraud_labels", ctes=labelled, select=f"SELECT transaction_id, is_fraud, split, round(probability, 9) AS probability, prediction FROM ({scored}) AS s")


def _stored_scores(bank: Bank, model: portable.Portable) -> DataFrame:
    rows = features.with_features(bank.gold, keep=["is_fraud"])
    rows = rows.withColumns({"is_fraud": F.col("is_fraud").cast("int"), "split": split_name(F.col("transaction_id"))})
    return model.score(rows, _SCORED_COLUMNS).withColumn("probability", F.round("probability", 9))


@query(_stored_sql(_STORED_LINEAR))
def score_logistic(bank: Bank) -> DataFrame:
    """All rows scored by a stored linear model."""
    return _stored_scores(bank, _STORED_LINEAR)


@query(_stored_sql(_STORED_BOOSTED))
def score_gbt(bank: Bank) -> DataFrame:
    """All rows scored by stored boosted trees."""
    return _stored_scores(bank, _STORED_BOOSTED)


@query()
def model_report(bank: Bank) -> DataFrame:
    """Train and test metrics of the refitted model."""
    training = _training(bank)
    categorical, numeric = learning.model_columns(training, NOT_INPUTS)
    model = learning.fit(_train_rows(training), LOGISTIC, categorical, numeric)
    return learning.evaluate(model, training)


@query()
def hpo_trials(bank: Bank) -> DataFrame:
    training = _training(bank)
    categorical, numeric = learning.model_columns(training, NOT_INPUTS)
    trials = learning.draw_trials()
    return learning.search(_train_rows(training), trials, categorical, numeric, STARTED_AT)


CUTOFFS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def _cutoff_trials(scored: DataFrame, started: str) -> DataFrame:
    """The rule at several cutoffs as a trial log: test F1 of each, from one aggregate."""
    test = scored.where(split_name(F.col("transaction_id")) == "test")
    positive = F.col("label") == 1

    def score(cutoff: float) -> Column:
        chosen = features.rule_prediction(F.col("risk_score"), cutoff) == 1
        return f1(F.count_if(chosen & positive), F.count_if(chosen & ~positive), F.count_if(~chosen & positive))

    scores = test.agg(*[score(c).alias(f"c{i}") for i, c in enumerate(CUTOFFS)])
    first = F.lit(started).cast("timestamp_ntz")
    rows = [
        F.struct(
            F.lit(f"cutoff-{c}").alias("run_id"),
            F.col(f"c{i}").alias("test_f1"),
            F.lit("FINISHED").alias("state"),
            F.timestamp_add("MINUTE", F.lit(i), first).alias("started_at"),
        )
        for i, c in enumerate(CUTOFFS)
    ]
    return scores.select(F.inline(F.array(*rows)))


_CUTOFF_SQL = " UNION ALL ".join(
    f"""SELECT 'cutoff-{c}' AS run_id, CAST(2 * tp{i} AS DOUBLE) / nullif(2 * tp{i} + fp{i} + fn{i}, 0) AS test_f1,
        'FINISHED' AS state, TIMESTAMP '2024-01-01' + INTERVAL {i} MINUTE AS started_at FROM counted"""
    for i, c in enumerate(CUTOFFS)
)
_CUTOFF_COUNTS = ", ".join(
    f"""count(*) FILTER (WHERE risk_score >= CAST({c} AS FLOAT) AND label = 1) AS tp{i},
        count(*) FILTER (WHERE risk_score >= CAST({c} AS FLOAT) AND label = 0) AS fp{i},
        count(*) FILTER (WHERE risk_score < CAST({c} AS FLOAT) AND label = 1) AS fn{i}"""
    for i, c in enumerate(CUTOFFS)
)


@query(
    over(
        "fraud_scored",
        "fraud_labels",
        ctes=f"""counted AS (SELECT {_CUTOFF_COUNTS} FROM fraud_scored JOIN fraud_labels USING (transaction_id)
                 WHERE split = 'test'), trials AS ({_CUTOFF_SQL})""",
        select="SELECT * FROM trials ORDER BY test_f1 DESC NULLS LAST, started_at DESC, run_id LIMIT 1",
    )
)
def best_trial(bank: Bank) -> DataFrame:
    return gates.best_trial(_cutoff_trials(bank.scored, "2024-01-01 00:00:00"))


WEIGHTS = {"amount": 4e-6, "balance_orig_ratio": 0.05, "is_cross_border": 0.7, "is_full_transfer": 1.1}

_ATTRIBUTED = "attributed AS (" + " UNION ALL ".join(
    f"""SELECT transaction_id, '{c}' AS feature, CAST({w} AS DOUBLE) * ({c} - avg({c}) OVER ()) AS value
        FROM fraud_features"""
    for c, w in WEIGHTS.items()
) + ")"


def _attributed(bank: Bank) -> DataFrame:
    rows = staged(features.with_features(bank.gold).select("transaction_id", *WEIGHTS), "features")
    return attribution.linear_attribution(rows, "transaction_id", WEIGHTS)


@query(
    over(
        "fraud_features",
        ctes=_ATTRIBUTED,
        select="SELECT transaction_id, feature, round(value, 6) AS value FROM attributed",
    )
)
def linear_attribution(bank: Bank) -> DataFrame:
    return _rounded(_attributed(bank), ["value"], 6)


@query(
    over(
        "fraud_features",
        ctes=_ATTRIBUTED,
        select="""SELECT feature, round(avg(abs(value)), 6) AS mean_abs_attribution FROM attributed
                  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    )
)
def global_importance(bank: Bank) -> DataFrame:
    return _rounded(attribution.global_importance(_attributed(bank)), ["mean_abs_attribution"], 6)


@query(
    over(
        "fraud_features",
        ctes=_ATTRIBUTED,
        select="SELECT transaction_id, "
        + ", ".join(f"round(max(value) FILTER (WHERE feature = '{c}'), 6) AS {c}" for c in WEIGHTS)
        + " FROM attributed GROUP BY 1",
    )
)
def row_explanations(bank: Bank) -> DataFrame:
    wide = attribution.row_explanations(_attributed(bank), "transaction_id", list(WEIGHTS))
    return _rounded(wide, list(WEIGHTS), 6)


EXPLAINED = ["amount", "balance_orig_ratio", "is_full_transfer", "is_cross_border", "type", "country"]

# A small forest over the six features. Its covers are counted on the training rows.
_INPUTS = {
    "amount": "amount", "balance_orig_ratio": "balance_orig_ratio", "is_full_transfer": "is_full_transfer", "is_cross_border": "is_cross_border",
    "type": "CASE WHEN type IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END", "country": "CASE WHEN country < 'N10' THEN 1 ELSE 0 END",
}
_FOREST = trees.Forest(
    (
        trees.Node(0, 0, left=1, right=2, place=0, threshold=150_000.0),
        trees.Node(0, 1, left=3, right=4, place=1, threshold=0.5),
        trees.Node(0, 2, left=5, right=6, place=2, threshold=0.5),
        trees.Node(0, 3, -0.6),
        trees.Node(0, 4, 0.2),
        trees.Node(0, 5, left=7, right=8, place=4, values=(0.0,)),
        trees.Node(0, 6, 1.4),
        trees.Node(0, 7, 0.4),
        trees.Node(0, 8, left=9, right=10, place=0, threshold=250_000.0),
        trees.Node(0, 9, 0.7),
        trees.Node(0, 10, 0.9),
        trees.Node(1, 0, left=1, right=2, place=5, values=(1.0,)),
        trees.Node(1, 1, left=3, right=4, place=1, threshold=1.0),
        trees.Node(1, 2, left=5, right=6, place=3, threshold=0.5),
        trees.Node(1, 3, left=7, right=8, place=1, threshold=0.25),
        trees.Node(1, 4, 0.35),
        trees.Node(1, 5, -0.15),
        trees.Node(1, 6, left=9, right=10, place=0, threshold=200_000.0),
        trees.Node(1, 7, -0.25),
        trees.Node(1, 8, 0.05),
        trees.Node(1, 9, 0.1),
        trees.Node(1, 10, 0.45),
    ),
    tuple(EXPLAINED),
)


def _forest_inputs() -> Column:
    return F.array(*[F.expr(f"cast({_INPUTS[c]} AS DOUBLE)") for c in EXPLAINED])


def _subset_sql() -> str:
    """Shapley values by their definition: the value of every one of the 64 sets of features, for every row."""
    nodes = {(n.tree, n.node): n for n in _FOREST.nodes}
    covers, terms = {}, []

    def goes(node: trees.Node, left: bool) -> str:
        column = f"x{node.place}"
        side = f"{column} <= {node.threshold}" if node.values is None else f"{column} IN ({', '.join(map(str, node.values))})"
        return side if left else f"NOT ({side})"

    def walk(node: trees.Node, above: list[tuple[trees.Node, bool]]):
        covers[node.tree, node.node] = " AND ".join(goes(*a) for a in above) or "true"
        if node.left >= 0:
            walk(nodes[node.tree, node.left], [*above, (node, True)])
            walk(nodes[node.tree, node.right], [*above, (node, False)])
            return
        factors = [f"CAST({node.value} AS DOUBLE)"]
        for parent, left in above:
            child = parent.left if left else parent.right
            share = f"CAST(n_{node.tree}_{child} AS DOUBLE) / n_{node.tree}_{parent.node}"
            factors.append(f"CASE WHEN s & {1 << parent.place} = 0 THEN {share} WHEN {goes(parent, left)} THEN 1 ELSE 0 END")
        terms.append(" * ".join(factors))

    for tree in (0, 1):
        walk(nodes[tree, 0], [])
    inputs = ", ".join(f"CAST({_INPUTS[c]} AS DOUBLE) AS x{k}" for k, c in enumerate(EXPLAINED))
    counts = ", ".join(f"count(*) FILTER (WHERE {condition}) AS n_{tree}_{node}" for (tree, node), condition in covers.items())
    names = " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(EXPLAINED))
    return over(
        "fraud_features",
        "fraud_labels",
        ctes=f"""x AS (SELECT transaction_id, split, {inputs} FROM fraud_features JOIN fraud_labels USING (transaction_id)),
            covers AS (SELECT {counts} FROM x WHERE split = 'train'), sets AS (SELECT CAST(unnest(range(64)) AS INT) AS s),
            worth AS (SELECT transaction_id, s, bit_count(s) AS size, {" + ".join(terms)} AS v FROM x, covers, sets WHERE split = 'test'),
            gains AS (SELECT a.transaction_id, j, (b.v - a.v) / (6 * list_extract([1, 5, 10, 10, 5, 1], a.size + 1)) AS gain
              FROM worth a JOIN (SELECT CAST(unnest(range(6)) AS INT) AS j) ON a.s & (1 << j) = 0 JOIN worth b ON b.transaction_id = a.transaction_id AND b.s = a.s + (1 << j))""",
        select=f"SELECT transaction_id, CASE j {names} END AS feature, round(sum(gain), 6) + 0.0 AS value FROM gains GROUP BY 1, 2",
    )


@query(_subset_sql())
def tree_attribution(bank: Bank) -> DataFrame:
    """Exact explanations of a fixed forest on the test rows, its shares counted on the training rows."""
    rows = staged(features.with_features(bank.gold).select("transaction_id", *EXPLAINED).withColumn("split", split_name(F.col("transaction_id"))), "explained")
    forest = trees.covered(_FOREST, _train_rows(rows), _forest_inputs())
    found = trees.tree_attribution(rows.where("split = 'test'"), "transaction_id", _forest_inputs(), forest)
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _explained_model(bank: Bank):
    """Rows with the six features and a boosted model of them."""
    training = staged(
        features.with_features(bank.gold, keep=["is_fraud"]).withColumns(
            {"is_fraud": F.col("is_fraud").cast("int"), "split": split_name(F.col("transaction_id"))}
        ),
        "explained",
    )
    categorical = ["type", "country"]
    numeric = [c for c in EXPLAINED if c not in categorical]
    return training, learning.fit(_train_rows(training), BOOSTED, categorical, numeric)


@query()
def boosted_attribution(bank: Bank) -> DataFrame:
    """Exact explanations of a boosted model on all test rows, in log-odds."""
    training, model = _explained_model(bank)
    return learning.explain_trees(model, training.where("split = 'test'"), "transaction_id")


@query()
def sampled_attribution(bank: Bank, percent: int = 100, rows: int | None = None, draws: int = attribution.DRAWS) -> DataFrame:
    """Sampled explanations of the same model on the test rows, or on some of them: the way for models without trees."""
    training, model = _explained_model(bank)
    explained = attribution.explained_rows(training.where("split = 'test'"), "transaction_id", percent, rows)
    return attribution.sampled_attribution(
        explained,
        _train_rows(training),
        "transaction_id",
        EXPLAINED,
        lambda rows: learning.score(model, rows),
        permutations=draws,
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ingest_events(bank: Bank) -> DataFrame:
    """Events written as JSON files and taken in one file per batch."""
    folder = scratch(bank.spark, "ingest")
    convert(bank.spark, f"{bank.folder}/events.parquet", "json", f"{folder}/raw", files=4)
    table = StreamTable(f"{folder}/events")
    run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", table, max_files=1))
    # JSON has no times: they arrive as text.
    return read_table(bank.spark, table).select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props"
    )


@query("SELECT c_custkey, c_name, c_acctbal, CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS c_mktsegment FROM customer")
def ingest_csv(bank: Bank) -> DataFrame:
    """Customers from CSV files whose columns come in other orders, the last with one inserted."""
    folder, customers = scratch(bank.spark, "ingest"), bank.table("customer")
    orders = ["c_custkey", "c_name", "c_acctbal"], ["c_acctbal", "c_custkey", "c_name"], ["c_custkey", "c_mktsegment", "c_name", "c_acctbal"]
    table = StreamTable(f"{folder}/customers")
    for k, columns in enumerate(orders):
        part = customers.where(F.pmod("c_custkey", F.lit(3)) == k).select(*columns)
        part.coalesce(1).write.mode("append").option("header", "true").csv(f"{folder}/raw")
        if k:  # the first two files come in one batch
            run_to_end(ingest_files(bank.spark, f"{folder}/raw", "csv", table))
    return read_table(bank.spark, table).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


@query(
    """SELECT n_name AS country, CAST(n_nationkey * 1.5 AS DOUBLE) AS long_avg, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey - 4.5 AS DOUBLE) END AS lat_avg,
       CAST(n_regionkey AS STRING) AS region FROM nation"""
)
def ingest_untyped(bank: Bank) -> DataFrame:
    """Nations from CSV files without types: all text, but for the coordinates, where text that is no number is null."""
    folder, region = scratch(bank.spark, "ingest"), F.col("n_regionkey").alias("region")
    even = F.when(F.col("n_nationkey") % 2 == 0, (F.col("n_nationkey") - 4.5).cast("string")).otherwise("unknown").alias("lat_avg")
    rows = bank.table("nation").select(F.col("n_name").alias("country"), (F.col("n_nationkey") * 1.5).alias("long_avg"), even, region)
    rows.repartition(3).write.option("header", "true").csv(f"{folder}/raw")
    table = StreamTable(f"{folder}/countries")
    run_to_end(ingest_files(bank.spark, f"{folder}/raw", "csv", table, prepare=with_coordinates, typed=False))
    return read_table(bank.spark, table).drop("_rescued_data")


@query("SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events")
def ingest_grown(bank: Bank) -> DataFrame:
    """Events from JSON files; the later ones have a field more."""
    folder, events = scratch(bank.spark, "ingest"), bank.table("events")
    table = StreamTable(f"{folder}/events")
    for k, columns in enumerate((["event_id", "user_id"], ["event_id", "props", "user_id"])):
        events.where(F.pmod("event_id", F.lit(2)) == k).select(*columns).coalesce(2).write.mode("append").json(f"{folder}/raw")
        run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", table))
    return read_table(bank.spark, table).select("event_id", "user_id", "props")


@query(
    """SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type, value,
       CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events"""
)
def ingest_nested(bank: Bank) -> DataFrame:
    """Events as objects and lists in JSON files; the later ones have a field more inside the object's object, and one inside the list."""
    folder, events = scratch(bank.spark, "ingest"), bank.table("events")
    table = StreamTable(f"{folder}/events")
    for k, (who, what) in enumerate((("user_id",), ("value",)) if k == 0 else (("user_id", "event_type"), ("value", "props")) for k in range(2)):
        event = F.struct(F.struct(*who).alias("who")).alias("event")
        rows = events.where(F.pmod("event_id", F.lit(2)) == k).select("event_id", event, F.array(F.struct(*what)).alias("items"))
        rows.coalesce(2).write.mode("append").json(f"{folder}/raw")
        run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", table))
    first = F.col("items")[0]
    return read_table(bank.spark, table).select("event_id", "event.who.user_id", "event.who.event_type", first["value"].alias("value"), first["props"].alias("props"))


@query(
    """SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN user_id END AS user_id, event_type AS kind,
       CASE WHEN event_id % 10 = 3 THEN '{"Event_id":' || event_id || ',"place":{"till":[1]},"user_id":"u' || user_id || '"}' END AS rescued FROM events"""
)
def ingest_rescued(bank: Bank) -> DataFrame:
    """Events from JSON files with settled columns; later some users are text, one name differs in case, and an object has a field more.

    Exactly these fields are rescued; the others of the same records keep their columns.
    """
    folder, events = scratch(bank.spark, "ingest"), bank.table("events").select("event_id", "user_id", "event_type")
    table, odd = StreamTable(f"{folder}/events"), F.pmod("event_id", F.lit(10)) == 3
    plain = events.where(~odd).select("event_id", "user_id", F.struct(F.col("event_type").alias("kind")).alias("place"))
    place = F.struct(F.col("event_type").alias("kind"), F.array(F.lit(1)).alias("till"))
    fields = {"event_id": F.col("event_id"), "Event_id": F.col("event_id"), "user_id": F.concat(F.lit("u"), F.col("user_id").cast("string")), "place": place}
    # Spark has no two columns that differ in case, so the text of the object is put together from its fields.
    texts = [F.concat(F.lit(f'"{name}":'), F.substring(F.to_json(F.struct(value.alias("x"))), 6, 1 << 30)) for name, value in fields.items()]
    late = events.where(odd).select(F.concat(F.lit("{"), F.array_join(F.array(*[F.substr(t, F.lit(1), F.length(t) - 1) for t in texts]), ","), F.lit("}")).alias("value"))
    plain.coalesce(2).write.json(f"{folder}/raw")
    run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", table))
    late.coalesce(2).write.mode("append").option("lineSep", "\n").text(f"{folder}/raw")
    run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", table, grow=False))
    return read_table(bank.spark, table).select("event_id", "user_id", "place.kind", F.col("_rescued_data").alias("rescued"))


@query(
    over(
        "bronze_transactions",
        "fraud_reports",
        select="""SELECT t.id, t.amount, newBalanceDest - oldBalanceDest AS "diffDest", is_fraud,
                  replace(t.countryOrig, '--', '') AS "countryOrig"
                  FROM bronze_transactions t LEFT JOIN fraud_reports f ON t.id = f.id""",
    )
)
def stream_silver(bank: Bank) -> DataFrame:
    """Silver built by a chain of streams, in batches of half the files and of one: raw files to a table, cleaned and labelled from there.

    After each round the first batch of the raw table comes a second time, as after a failure; nothing may come through twice.
    """
    folder = scratch(bank.spark, "silver")
    bronze, silver = StreamTable(f"{folder}/bronze"), StreamTable(f"{folder}/silver")
    files = max(4, int(bank.spark.conf.get("spark.sql.shuffle.partitions")))  # a task writes one
    bank.transactions.repartition(files).write.json(f"{folder}/raw")
    reports = staged(bank.reports, "reports")  # each batch reads them
    for _ in range(2):  # the second round finds nothing new
        run_to_end(ingest_files(bank.spark, f"{folder}/raw", "json", bronze, max_files=-(-files // 2)))
        run_to_end(follow(bank.spark, bronze, silver, lambda rows: layers.silver(rows, reports), max_batches=1))
        write_batch(read_table(bank.spark, bronze), bronze, [], 0)
    return read_table(bank.spark, silver).select("id", "amount", "diffDest", "is_fraud", "countryOrig")


@query(
    over(
        "fraud_scored",
        select="""SELECT CAST(o_orderkey AS STRING) AS transaction_id, s.risk_score, s.prediction
                  FROM orders LEFT JOIN fraud_scored s ON s.transaction_id = CAST(o_orderkey AS STRING)""",
    )
)
def stream_scores(bank: Bank) -> DataFrame:
    """A stream of order ids scored against the feature snapshot; ids without features keep null scores."""
    spark = bank.spark
    orders = spark.readStream.schema(bank.table("orders").schema).option("pathGlobFilter", "orders.parquet")
    requests = orders.parquet(bank.folder).select(F.col("o_orderkey").cast("string").alias("transaction_id"))

    def score(rows: DataFrame) -> DataFrame:
        scored = RISK_SCORE.add_to(rows)
        known = F.col("amount").isNotNull()
        return scored.select(
            "transaction_id",
            F.when(known, F.col("risk_score")).alias("risk_score"),
            F.when(known, features.rule_prediction(F.col("risk_score"))).alias("prediction"),
        )

    table = StreamTable(f"{scratch(spark, 'scores')}/scores")
    snapshot = bucketed(features.with_features(bank.gold), "transaction_id", "snapshot")  # no batch shuffles it
    run_to_end(append_stream(score_requests(requests, snapshot, score), table))
    return read_table(spark, table)
