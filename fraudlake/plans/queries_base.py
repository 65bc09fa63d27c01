"""Sources, projections, joins, aggregations, statistics, splits."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..operators import aggregates as A
from ..operators import features, joins, profile, splitting, stats
from ..operators.ranking import hash_sample
from ..session import shared_dir
from ..sources import adapter as src
from ..sources import footers, readers, schema, sinks
from .registry import check_sql, query, rounded
from .reports import MEAN_COLUMNS, Reports

txn, ident, scored = src.transactions, src.identity, src.scored
ALL = ", ".join(src.TXN_COLUMNS)

# ---------------------------------------------------------------- sources, sinks

CSV_COLUMNS = ["TransactionID", "TransactionDT", "TransactionAmt", "isFraud", "ProductCD", "addr1",
               "card6", "P_emaildomain", "D1"]


@query("scan_csv", check_sql(
    "SELECT TransactionID, TransactionDT, TransactionAmt, CAST(isFraud AS BIGINT) AS isFraud, ProductCD,"
    " CAST(addr1 AS DOUBLE) AS addr1, card6, P_emaildomain, D1 FROM txn", "txn"))
def _(spark, sf):
    path = shared_dir(spark)
    txn(spark, sf, *CSV_COLUMNS).write.option("header", True).csv(path)
    return readers.read_csv(spark, path)


@query("scan_parquet", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    events = readers.read_parquet(spark, f"{sf}/events.parquet")
    return events.select("event_id", "user_id", "event_type", "value")


@query("sink_parquet", check_sql(f"SELECT {ALL} FROM txn", "txn"))
def _(spark, sf):
    return spark.read.parquet(sinks.write_parquet(txn(spark, sf), shared_dir(spark)))


@query("validate_schema", check_sql(
    "\nUNION ALL\n".join([
        *[f"SELECT 'transactions' AS table_name, '{c}' AS column_name, true AS present,"
          f" count({c}) AS n_values FROM txn" for c in C.REQUIRED_TRANSACTION_COLUMNS],
        "SELECT 'identity', 'TransactionID', true, count(TransactionID) FROM ident",
        "SELECT 'identity', 'DeviceInfo', false, 0"]), "txn", "ident"))
def _(spark, sf):
    t = schema.validation_report(txn(spark, sf, *C.REQUIRED_TRANSACTION_COLUMNS),
                                 C.REQUIRED_TRANSACTION_COLUMNS, "transactions")
    i = schema.validation_report(ident(spark, sf), [C.KEY, "DeviceInfo"], "identity")
    return t.unionByName(i)


_REQUIRED = {"events": ["event_id", "ts", "value", "props", "device"], "customer": ["c_custkey", "c_mktsegment"]}


@query("validate_files", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {str(c != 'device').lower()} AS present,"
    f" {'0' if c == 'device' else f'count({c})'} AS n_values FROM {t if c != 'device' else '(SELECT 1)'}"
    for t, names in _REQUIRED.items() for c in names))
def _(spark, sf):
    """The column check from the files' footers: no value is read."""
    return reduce(DataFrame.unionByName, [
        footers.from_footers(spark, lambda d, t=t: schema.validation_report(d, _REQUIRED[t], t), f"{sf}/{t}.parquet")
        for t in _REQUIRED])


@query("extents_files", "SELECT count(*) AS n_rows, count(event_id) AS event_id_values, min(event_id) AS"
       " event_id_smallest, max(event_id) AS event_id_largest, count(value) AS value_values, min(value) AS"
       " value_smallest, max(value) AS value_largest FROM events")
def _(spark, sf):
    return footers.from_footers(spark, lambda d: footers.extents(d, ["event_id", "value"]), f"{sf}/events.parquet")


@query("ingestion_summary", check_sql(
    "SELECT (SELECT count(*) FROM txn) AS transaction_rows,"
    f" CAST({len(src.TXN_COLUMNS)} AS BIGINT) AS transaction_columns,"
    " (SELECT count(*) FROM ident) AS identity_rows, CAST(3 AS BIGINT) AS identity_columns,"
    " true AS identity_file_used, count(*) AS merged_rows,"
    f" CAST({len(src.TXN_COLUMNS) + 2} AS BIGINT) AS merged_columns,"
    " 'TransactionID' AS join_key, 'left' AS join_type,"
    " count(*) = (SELECT count(*) FROM txn) AS row_count_preserved,"
    " count(*) FILTER (WHERE split = 'train') AS train_rows,"
    " count(*) FILTER (WHERE split = 'test') AS test_rows,"
    " CAST(round_even(CAST(avg(isFraud) FILTER (WHERE split = 'train') AS DOUBLE) * 1e4, 0) AS DOUBLE) / 1e4"
    " AS fraud_rate_train,"
    " CAST(round_even(CAST(avg(isFraud) FILTER (WHERE split = 'test') AS DOUBLE) * 1e4, 0) AS DOUBLE) / 1e4"
    " AS fraud_rate_test"
    " FROM parts LEFT JOIN ident USING (TransactionID)", "txn", "ident", "parts"))
def _(spark, sf):
    t, i = txn(spark, sf), ident(spark, sf)
    marked = joins.attach_identity(splitting.mark_split(t), i)
    return splitting.ingestion_summary(t, i, marked)


@query("load_analytic_table", check_sql(
    f"SELECT count(*) AS rows_loaded, CAST({len(src.TXN_COLUMNS)} AS BIGINT) AS n_columns,"
    " 'transactions_report' AS table_name, round(sum(TransactionAmt), 2) AS total_amount, "
    + ", ".join(f"count({c}) AS n_{c}" for c in src.TXN_COLUMNS) + " FROM txn", "txn"))
def _(spark, sf):
    """All columns of both splits; every column is read back from the table."""
    table = f"transactions_report_{uuid.uuid4().hex}"  # sessions share the catalog
    parts = splitting.temporal_split(txn(spark, sf))
    t = sinks.load_table(list(parts), table, shared_dir(spark))
    return t.agg(F.count(F.lit(1)).alias("rows_loaded"),
                 F.lit(len(t.columns)).cast("long").alias("n_columns"),
                 F.lit("transactions_report").alias("table_name"),
                 F.round(F.sum(C.AMOUNT), 2).alias("total_amount"),
                 *[F.count(c).alias("n_" + c) for c in t.columns])


_TYPES = {"TransactionID": "BIGINT", "TransactionAmt": "DOUBLE", "isFraud": "BIGINT",
          "ProductCD": "VARCHAR(64)", "card4": "VARCHAR(64)", "card6": "VARCHAR(64)", "D1": "DOUBLE"}


@query("infer_sql_schema", check_sql("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS sql_type, "
    + (f"CAST(max(length({c})) AS BIGINT)" if t[0] == "V" else "CAST(max(0) AS BIGINT)")
    + f" AS longest_text, {f'max(length({c})) <= 64' if t[0] == 'V' else 'true'} AS fits FROM txn"
    for c, t in _TYPES.items()), "txn"))
def _(spark, sf):
    return schema.sql_schema_report(txn(spark, sf, *_TYPES))


@query("dtype_census", """
SELECT 'bigint' AS dtype, CAST(2 AS BIGINT) AS n_columns, CAST(count(*) * 16 AS BIGINT) AS n_bytes FROM orders
UNION ALL SELECT 'double', 1, count(*) * 8 FROM orders
UNION ALL SELECT 'timestamp_ntz', 1, count(*) * 8 FROM orders
UNION ALL SELECT 'string', 2, CAST(sum(strlen(o_orderstatus) + strlen(o_orderpriority)) AS BIGINT) FROM orders""")
def _(spark, sf):
    return schema.dtype_census(src.table(spark, sf, "orders"))


# ---------------------------------------------------------------- projections

@query("feat_amount", check_sql(
    "SELECT TransactionID, ln(1 + TransactionAmt) AS TransactionAmt_log,"
    " CAST(trunc((TransactionAmt - trunc(TransactionAmt)) * 1000) AS BIGINT) AS TransactionAmt_decimal"
    " FROM txn", "txn", round6="TransactionAmt_log"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, C.AMOUNT)
    return rounded(t.select(C.KEY, *[e.alias(n) for n, e in features.engineered(t).items()]))


@query("feat_time", check_sql(
    "SELECT TransactionID, fmod(TransactionDT / 3600::DOUBLE, 24::DOUBLE) AS Transaction_hour,"
    " fmod(TransactionDT / 86400::DOUBLE, 7::DOUBLE) AS Transaction_day FROM txn",
    "txn"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, C.TIME)
    return t.select(C.KEY, *[e.alias(n) for n, e in features.engineered(t).items()])


@query("hour_bin", check_sql(
    "SELECT TransactionID, CAST(trunc(fmod(TransactionDT / 3600::DOUBLE, 24::DOUBLE)) AS BIGINT) AS hour"
    " FROM txn", "txn"))
def _(spark, sf):
    return txn(spark, sf, C.KEY, C.TIME).select(C.KEY, X.hour_bin(C.TIME).alias("hour"))


def _case_bins(x, edges, labels, what):
    arms = " ".join(
        f"WHEN {x} > {lo} AND {x} <= {'1e308' if hi == float('inf') else hi} THEN "
        + (f"'{lab}'" if what == "label" else str(i))
        for i, (lo, hi, lab) in enumerate(zip(edges, edges[1:], labels)))
    return f"CASE {arms} END"


_BIN = _case_bins(C.AMOUNT, C.AMOUNT_EDGES, C.AMOUNT_LABELS, "bin")
_BIN_LABEL = _case_bins(C.AMOUNT, C.AMOUNT_EDGES, C.AMOUNT_LABELS, "label")


@query("bin_amount", check_sql(
    f"SELECT TransactionID, {_BIN} AS bin, {_BIN_LABEL} AS label FROM txn", "txn"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, C.AMOUNT).select(
        C.KEY, X.right_closed_bin(C.AMOUNT, C.AMOUNT_EDGES).alias("bin"))
    return t.withColumn("label", X.bin_label("bin", C.AMOUNT_LABELS))


_MISSING = "missing_counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing, count(*) AS n FROM txn"
    for c in src.TXN_COLUMNS) + "), pct AS (SELECT *, missing * 100 / n AS pct FROM missing_counts)"


@query("missing_bins", check_sql(
    f"SELECT {_case_bins('pct', C.MISSING_EDGES, C.MISSING_LABELS, 'bin')} AS bin,"
    f" {_case_bins('pct', C.MISSING_EDGES, C.MISSING_LABELS, 'label')} AS label,"
    " count(*) AS n_features FROM pct WHERE missing > 0 GROUP BY 1, 2", "txn", more=_MISSING))
def _(spark, sf):
    return profile.missing_bins(txn(spark, sf))


_FEATURES = [c for c in C.ALL_FEATURES if c in src.TXN_COLUMNS]


@query("select_features", check_sql(f"SELECT {', '.join(_FEATURES)}, isFraud FROM txn", "txn"))
def _(spark, sf):
    return features.select_features(txn(spark, sf))


@query("align_columns", check_sql(
    "SELECT TransactionID, TransactionAmt, (SELECT median(D1) FROM txn) AS D1, 0.0::DOUBLE AS dist2,"
    " C1, isFraud FROM txn", "txn"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET, "C1", "D1", "V1")
    medians = features.fit_medians(t, ["D1"])
    return features.align(t.drop("D1"), [C.AMOUNT, "D1", "dist2", "C1"], medians, keep=(C.KEY,))


@query("drop_columns", check_sql(
    "SELECT TransactionID, TransactionAmt, ProductCD FROM txn", "txn"))
def _(spark, sf):
    from ..operators.scenarios import lost_identity

    t = txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET, "ProductCD")
    return lost_identity(joins.attach_identity(t, ident(spark, sf))).drop(C.TARGET)


@query("filter_rows", check_sql(
    "SELECT TransactionID, TransactionAmt, card1, C1, D1 FROM txn"
    " WHERE TransactionAmt <= 1000 AND isFraud = 0", "txn"))
def _(spark, sf):
    from ..operators.drift import numeric_columns

    t = txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET, "card1", "C1", "D1", "ProductCD")
    return t.where((F.col(C.AMOUNT) <= 1000) & (F.col(C.TARGET) == 0)).select(numeric_columns(t))


@query("label_map", check_sql(
    "SELECT TransactionID, CASE isFraud WHEN 0 THEN 'Legitimate' WHEN 1 THEN 'Fraud' END AS label FROM txn",
    "txn"))
def _(spark, sf):
    return txn(spark, sf, C.KEY, C.TARGET).select(C.KEY, X.class_label().alias("label"))


@query("score_output", check_sql(
    "SELECT TransactionID, CAST(round_even(score * 1e4::DOUBLE, 0) AS DOUBLE) / 1e4 AS fraud_probability,"
    " score >= 0.5::DOUBLE AS is_fraud,"
    " CAST(round_even(greatest(score, 1::DOUBLE - score) * 1e4::DOUBLE, 0) AS DOUBLE) / 1e4 AS confidence"
    " FROM scored", "scored"))
def _(spark, sf):
    return scored(spark, sf).select(C.KEY, *[e.alias(n) for n, e in X.score_columns("score").items()])


@query("risk_band", check_sql(
    "SELECT TransactionID, CASE WHEN floor(score * 100 + 0.5::DOUBLE) >= 70 THEN 'high'"
    " WHEN floor(score * 100 + 0.5::DOUBLE) >= 40 THEN 'medium' ELSE 'low' END AS band FROM scored",
    "scored"))
def _(spark, sf):
    return scored(spark, sf).select(C.KEY, X.risk_band("score").alias("band"))


@query("payload_defaults", check_sql(
    "SELECT TransactionID, CASE WHEN C1 = 0 THEN 100.0::DOUBLE ELSE TransactionAmt END AS TransactionAmt,"
    " coalesce(CAST(addr1 AS DOUBLE), 0.0::DOUBLE) AS addr1, coalesce(card6, 'debit') AS card6, ProductCD,"
    " 'gmail.com' AS P_emaildomain, 0.0::DOUBLE AS C2, CAST(V1 AS VARCHAR) AS extra_V1 FROM txn", "txn"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, C.AMOUNT, "addr1", "card6", "ProductCD", "V1", "C1")
    payload = F.to_json(F.struct(
        F.when(F.col("C1") != 0, F.col(C.AMOUNT)).alias(C.AMOUNT), "addr1", "card6", "ProductCD", "V1"))
    got = X.with_payload_defaults(t.select(C.KEY, payload.alias("payload")), "payload")
    return got.select(C.KEY, C.AMOUNT, "addr1", "card6", "ProductCD", "P_emaildomain", "C2",
                      F.col("extras")["V1"].alias("extra_V1"))


@query("payload_key", check_sql(
    "SELECT TransactionID, 'pred:' || sha256(CAST(to_json({'ProductCD': ProductCD, 'addr1': addr1,"
    " 'card1': card1, 'card6': card6}) AS VARCHAR)) AS request_key FROM txn", "txn"))
def _(spark, sf):
    t = txn(spark, sf, C.KEY, "ProductCD", "card1", "addr1", "card6")
    return t.select(C.KEY, X.payload_key(["card6", "card1", "addr1", "ProductCD"]).alias("request_key"))


# ---------------------------------------------------------------- joins

@query("join_left_identity", check_sql(
    "SELECT TransactionID, TransactionAmt, isFraud, id_01, DeviceType FROM txn LEFT JOIN ident"
    " USING (TransactionID)", "txn", "ident"))
def _(spark, sf):
    return joins.attach_identity(txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET), ident(spark, sf))


@query("join_fanout_check", check_sql(
    "SELECT TransactionID, count(*) AS n_rows FROM (SELECT * FROM ident UNION ALL"
    " SELECT * FROM ident WHERE DeviceType = 'mobile') GROUP BY 1 HAVING count(*) > 1", "ident"))
def _(spark, sf):
    i = ident(spark, sf)
    return joins.duplicate_keys(i.unionByName(i.where("DeviceType = 'mobile'")))


@query("join_coverage", check_sql(
    "SELECT count(*) AS n_rows, count(*) - count(id_01) AS rows_without_partner,"
    " (count(*) - count(id_01)) * 100 / count(*) AS pct_without_partner,"
    " ((count(*) - count(id_01)) / count(*) + (count(*) - count(DeviceType)) / count(*)) / 2 * 100"
    " AS mean_missing_pct, CAST(2 AS BIGINT) AS n_side_columns"
    " FROM txn LEFT JOIN ident USING (TransactionID)", "txn", "ident",
    round6="pct_without_partner mean_missing_pct"))
def _(spark, sf):
    j = joins.attach_identity(txn(spark, sf, C.KEY), ident(spark, sf))
    return rounded(joins.coverage(j, ["id_01", "DeviceType"]))


@query("label_coverage", check_sql(
    "SELECT count(*) AS n_rows, count(*) - count(quality) AS rows_without_partner,"
    " (count(*) - count(quality)) * 100 / count(*) AS pct_without_partner,"
    " ((count(*) - count(quality)) / count(*) + (count(*) - count(toxic)) / count(*)) / 2 * 100"
    " AS mean_missing_pct, CAST(2 AS BIGINT) AS n_side_columns"
    " FROM documents LEFT JOIN labels USING (doc_id)", round6="pct_without_partner mean_missing_pct"))
def _(spark, sf):
    docs, labels = src.table(spark, sf, "documents"), src.table(spark, sf, "labels")
    j = joins.attach_identity(docs.select("doc_id"), labels, "doc_id")
    return rounded(joins.coverage(j, ["quality", "toxic"]))


@query("inner_join_loss", check_sql(
    "SELECT count(*) AS n_rows, count(*) FILTER (WHERE i.TransactionID IS NULL) AS lost_rows,"
    " count(*) FILTER (WHERE i.TransactionID IS NULL) * 100 / count(*) AS lost_pct"
    " FROM txn t LEFT JOIN (SELECT DISTINCT TransactionID FROM ident) i USING (TransactionID)",
    "txn", "ident", round6="lost_pct"))
def _(spark, sf):
    return rounded(joins.inner_join_loss(txn(spark, sf, C.KEY), ident(spark, sf)))


@query("union_splits", check_sql(
    "SELECT TransactionID, TransactionAmt, isFraud, split FROM parts", "parts"))
def _(spark, sf):
    train, test = splitting.temporal_split(txn(spark, sf, C.KEY, C.TIME, C.AMOUNT, C.TARGET))
    return joins.stack_splits(train, test).drop(C.TIME)


def _overlap_sql(left, right, lname, rname):
    rows = []
    for c in sorted({*left, *right}):
        a = f"(SELECT count({c}) FROM {lname})" if c in left else "CAST(NULL AS BIGINT)"
        b = f"(SELECT count({c}) FROM {rname})" if c in right else "CAST(NULL AS BIGINT)"
        status = "common" if c in left and c in right else "missing" if c in left else "extra"
        rows.append(f"SELECT '{c}' AS feature, {str(c in left).lower()} AS in_reference, {a} AS"
                    f" values_reference, {str(c in right).lower()} AS in_current, {b} AS values_current,"
                    f" '{status}' AS status")
    return "\nUNION ALL\n".join(rows)


@query("common_columns", check_sql(
    _overlap_sql(["TransactionID", "TransactionAmt", "D1"], ["TransactionID", "id_01", "DeviceType"],
                 "txn", "ident"), "txn", "ident"))
def _(spark, sf):
    return joins.column_overlap(txn(spark, sf, C.KEY, C.AMOUNT, "D1"), ident(spark, sf))


@query("common_columns_files", _overlap_sql(
    ["doc_id", "text", "lang", "source", "n_chars"], ["doc_id", "quality", "toxic"], "documents", "labels"))
def _(spark, sf):
    return footers.from_footers(
        spark, joins.column_overlap, f"{sf}/documents.parquet", f"{sf}/labels.parquet")


# ---------------------------------------------------------------- aggregations

@query("rate_by_product", check_sql(
    "SELECT ProductCD, count(*) AS txn_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
    " round(avg(isFraud) * 100, 2) AS fraud_rate_pct FROM txn GROUP BY ProductCD", "txn"))
def _(spark, sf):
    return A.rate_by(txn(spark, sf, "ProductCD", C.TARGET), "ProductCD")


@query("amount_by_class", check_sql(
    "SELECT isFraud, count(*) AS txn_count, round(avg(TransactionAmt), 2) AS avg_amount,"
    " round(min(TransactionAmt), 2) AS min_amount, round(max(TransactionAmt), 2) AS max_amount"
    " FROM txn GROUP BY isFraud", "txn"))
def _(spark, sf):
    return A.amount_by_class(txn(spark, sf, C.AMOUNT, C.TARGET))


@query("rate_by_card", check_sql(
    "SELECT card6, count(*) AS txn_count, round(avg(isFraud) * 100, 2) AS fraud_rate_pct"
    " FROM txn GROUP BY card6", "txn"))
def _(spark, sf):
    return A.rate_by(txn(spark, sf, "card6", C.TARGET), "card6", with_positives=False)


@query("feature_means_by_class", check_sql(
    "SELECT isFraud, " + ", ".join(f"round(avg(C{i}), 4) AS C{i}" for i in range(1, 7))
    + " FROM txn GROUP BY isFraud", "txn"))
def _(spark, sf):
    cols = [f"C{i}" for i in range(1, 7)]
    return A.means_by_class(txn(spark, sf, C.TARGET, *cols), cols)


@query("overall_summary", check_sql(
    "SELECT count(*) AS total_rows, CAST(sum(isFraud) AS BIGINT) AS total_fraud,"
    " round(avg(isFraud) * 100, 2) AS fraud_rate_pct, round(avg(TransactionAmt), 2) AS avg_amount FROM txn",
    "txn"))
def _(spark, sf):
    return A.overall(txn(spark, sf, C.TARGET, C.AMOUNT))


@query("summary_ext", check_sql(
    "SELECT ProductCD, count(isFraud) AS transactions, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
    " avg(isFraud) * 100 AS fraud_rate_pct, avg(TransactionAmt) AS avg_amount,"
    " max(TransactionAmt) AS max_amount FROM txn WHERE ProductCD IS NOT NULL GROUP BY 1",
    "txn", round6="fraud_rate_pct avg_amount max_amount"))
def _(spark, sf):
    return rounded(A.product_amounts(txn(spark, sf, "ProductCD", C.TARGET, C.AMOUNT)))


@query("median_by_class", check_sql(
    "SELECT CASE isFraud WHEN 0 THEN 'Legitimate' ELSE 'Fraud' END AS label, count(TransactionAmt) AS n,"
    " avg(TransactionAmt) AS mean_amount, median(TransactionAmt) AS median_amount FROM txn GROUP BY 1",
    "txn", round6="mean_amount median_amount"))
def _(spark, sf):
    return rounded(A.median_by_class(txn(spark, sf, C.TARGET, C.AMOUNT)))


@query("class_balance", check_sql(
    "SELECT isFraud, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM txn) AS pct,"
    " (SELECT count(*) FILTER (WHERE isFraud = 0) / count(*) FILTER (WHERE isFraud = 1) FROM txn)"
    " AS imbalance_ratio FROM txn GROUP BY 1", "txn", round6="pct imbalance_ratio"))
def _(spark, sf):
    return rounded(A.class_balance(txn(spark, sf, C.TARGET)))


@query("describe_by_class", check_sql(
    "SELECT isFraud, count(TransactionAmt) AS n, avg(TransactionAmt) AS mean,"
    " stddev_samp(TransactionAmt) AS std, min(TransactionAmt) AS min,"
    " quantile_cont(TransactionAmt, 0.25) AS q25, quantile_cont(TransactionAmt, 0.5) AS q50,"
    " quantile_cont(TransactionAmt, 0.75) AS q75, max(TransactionAmt) AS max FROM txn GROUP BY 1",
    "txn", round6="mean std min q25 q50 q75 max"))
def _(spark, sf):
    return rounded(A.describe_by_class(txn(spark, sf, C.TARGET, C.AMOUNT)))


@query("median_ratio", check_sql(
    "SELECT *, median_fraud / median_legit AS ratio FROM (SELECT count(*) FILTER (WHERE isFraud = 0) AS"
    " n_legit, count(*) FILTER (WHERE isFraud = 1) AS n_fraud,"
    " median(TransactionAmt) FILTER (WHERE isFraud = 0) AS median_legit,"
    " median(TransactionAmt) FILTER (WHERE isFraud = 1) AS median_fraud FROM txn)",
    "txn", round6="median_legit median_fraud ratio"))
def _(spark, sf):
    return rounded(A.median_ratio(txn(spark, sf, C.TARGET, C.AMOUNT)))


@query("rate_by_amount_bin", check_sql(
    f"SELECT {_BIN} AS bin, {_BIN_LABEL} AS label, count(isFraud) AS n,"
    " CAST(sum(isFraud) AS BIGINT) AS fraud_count, avg(isFraud) AS fraud_rate,"
    " avg(isFraud) * 100 AS fraud_rate_pct FROM txn WHERE TransactionAmt > 0 GROUP BY 1, 2",
    "txn", round6="fraud_rate fraud_rate_pct"))
def _(spark, sf):
    return rounded(A.rate_by_amount_bin(txn(spark, sf, C.AMOUNT, C.TARGET)))


_HOUR = "CAST(trunc(fmod(TransactionDT / 3600::DOUBLE, 24::DOUBLE)) AS BIGINT)"
_HOURLY = (f"SELECT {_HOUR} AS hour, count(isFraud) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
           " avg(isFraud) AS fraud_rate FROM txn GROUP BY 1")


@query("rate_by_hour", check_sql(_HOURLY, "txn", round6="fraud_rate"))
def _(spark, sf):
    return rounded(A.rate_by_hour(txn(spark, sf, C.TIME, C.TARGET)))


@query("top_hours", check_sql(_HOURLY + " ORDER BY fraud_rate DESC, hour LIMIT 5", "txn", round6="fraud_rate"))
def _(spark, sf):
    return rounded(A.top_hours(txn(spark, sf, C.TIME, C.TARGET), 5))


@query("pivot_hour_class", check_sql(
    f"SELECT {_HOUR} AS hour, count(*) FILTER (WHERE isFraud = 0) AS legitimate,"
    " count(*) FILTER (WHERE isFraud = 1) AS fraud FROM txn GROUP BY 1", "txn"))
def _(spark, sf):
    return A.hour_class_counts(txn(spark, sf, C.TIME, C.TARGET))


@query("product_share", check_sql(
    "SELECT ProductCD, count(isFraud) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
    " avg(isFraud) AS fraud_rate, avg(isFraud) * 100 AS fraud_rate_pct,"
    " count(isFraud) * 100 / (SELECT count(*) FROM txn) AS pct_of_total FROM txn"
    " WHERE ProductCD IS NOT NULL GROUP BY 1", "txn", round6="fraud_rate fraud_rate_pct pct_of_total"))
def _(spark, sf):
    return rounded(A.product_share(txn(spark, sf, "ProductCD", C.TARGET)))


def _topk_sql(col, k):
    return (f"SELECT {col} AS category, count(isFraud) AS n, avg(isFraud) AS fraud_rate,"
            " avg(isFraud) > (SELECT avg(isFraud) FROM txn) AS above_overall FROM txn"
            f" WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY n DESC, category LIMIT {k}")


@query("rate_topk_category", check_sql(
    f"SELECT 'card4' AS feature, * FROM ({_topk_sql('card4', 6)}) UNION ALL"
    f" SELECT 'card6', * FROM ({_topk_sql('card6', 4)})", "txn", round6="fraud_rate"))
def _(spark, sf):
    t = txn(spark, sf, "card4", "card6", C.TARGET)
    parts = [A.rate_topk(t, c, k).select(F.lit(c).alias("feature"), "*") for c, k in (("card4", 6), ("card6", 4))]
    return rounded(parts[0].unionByName(parts[1]))


_REPORT_COLUMNS = [C.TIME, C.AMOUNT, C.TARGET, "ProductCD", "card4", "card6", *MEAN_COLUMNS]


def _long_sql(report, body, key, *measures):
    return "\nUNION ALL\n".join(
        f"SELECT '{report}' AS report, CAST({key} AS VARCHAR) AS group_key, '{m}' AS measure,"
        f" CAST({m} AS DOUBLE) AS value FROM ({body}) x" for m in measures)


def _long(report, df, key, *measures):
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    return df.select(F.lit(report).alias("report"), (F.lit("all") if key is None else F.col(key)).cast("string")
                     .alias("group_key"), F.inline(cells))


_REPORTS_SQL = [
    ("D1", "SELECT ProductCD, count(*) AS txn_count, sum(isFraud) AS fraud_count, round(avg(isFraud) * 100, 2)"
     " AS fraud_rate_pct FROM txn GROUP BY 1", "ProductCD", "txn_count", "fraud_count", "fraud_rate_pct"),
    ("D2", "SELECT isFraud, count(*) AS txn_count, round(avg(TransactionAmt), 2) AS avg_amount,"
     " round(min(TransactionAmt), 2) AS min_amount, round(max(TransactionAmt), 2) AS max_amount FROM txn GROUP BY 1",
     "isFraud", "txn_count", "avg_amount", "min_amount", "max_amount"),
    ("D3", "SELECT card6, count(*) AS txn_count, round(avg(isFraud) * 100, 2) AS fraud_rate_pct FROM txn GROUP BY 1",
     "card6", "txn_count", "fraud_rate_pct"),
    ("D4", "SELECT isFraud, " + ", ".join(f"round(avg({c}), 4) AS {c}" for c in MEAN_COLUMNS)
     + " FROM txn GROUP BY 1", "isFraud", *MEAN_COLUMNS),
    ("D5", "SELECT count(*) AS total_rows, sum(isFraud) AS total_fraud, round(avg(isFraud) * 100, 2) AS"
     " fraud_rate_pct, round(avg(TransactionAmt), 2) AS avg_amount FROM txn", "'all'", "total_rows", "total_fraud",
     "fraud_rate_pct", "avg_amount"),
    ("D10", f"SELECT {_BIN} AS bin, count(isFraud) AS n, sum(isFraud) AS fraud_count, avg(isFraud) AS fraud_rate"
     " FROM txn WHERE TransactionAmt > 0 GROUP BY 1", "bin", "n", "fraud_count", "fraud_rate"),
    ("D11", _HOURLY, "hour", "n", "fraud_count", "fraud_rate"),
    ("D12", f"SELECT {_HOUR} AS hour, count(*) FILTER (WHERE isFraud = 0) AS legitimate,"
     " count(*) FILTER (WHERE isFraud = 1) AS fraud FROM txn GROUP BY 1", "hour", "legitimate", "fraud"),
    ("D13", "SELECT ProductCD, count(isFraud) AS n, avg(isFraud) AS fraud_rate, count(isFraud) * 100 /"
     " (SELECT count(*) FROM txn) AS pct_of_total FROM txn WHERE ProductCD IS NOT NULL GROUP BY 1",
     "ProductCD", "n", "fraud_rate", "pct_of_total"),
    ("D14", _topk_sql("card4", 6), "category", "n", "fraud_rate", "above_overall"),
]


@query("standard_reports", check_sql("\nUNION ALL\n".join(_long_sql(*r) for r in _REPORTS_SQL), "txn",
                                     round6="value"))
def _(spark, sf):
    """Ten reports from one scan, as (report, group, measure, value)."""
    r = Reports(txn(spark, sf, *_REPORT_COLUMNS))
    frames = [r.rate_by("ProductCD"), r.amount_by_class(), r.rate_by("card6", with_positives=False),
              r.means_by_class(), r.overall(), r.rate_by_amount_bin(), r.rate_by_hour(), r.hour_class_counts(),
              r.product_share(), r.rate_topk("card4", 6)]
    parts = [_long(name, df, None if key == "'all'" else key, *measures)
             for df, (name, _, key, *measures) in zip(frames, _REPORTS_SQL)]
    return rounded(reduce(DataFrame.unionByName, parts))


@query("high_risk_groups", check_sql(
    "SELECT P_emaildomain, count(isFraud) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
    " avg(isFraud) AS fraud_rate, avg(isFraud) * 100 AS fraud_rate_pct FROM txn"
    " WHERE P_emaildomain IS NOT NULL GROUP BY 1 HAVING count(isFraud) >= 1000"
    " ORDER BY fraud_rate DESC, 1 LIMIT 10", "txn", round6="fraud_rate fraud_rate_pct"))
def _(spark, sf):
    return rounded(A.high_risk(txn(spark, sf, "P_emaildomain", C.TARGET), "P_emaildomain", 1000, 10))


@query("high_risk_cards", check_sql(
    "SELECT card1, count(isFraud) AS n, CAST(sum(isFraud) AS BIGINT) AS fraud_count,"
    " avg(isFraud) AS fraud_rate, avg(isFraud) * 100 AS fraud_rate_pct FROM txn"
    " WHERE card1 IS NOT NULL GROUP BY 1 HAVING count(isFraud) >= 60"
    " ORDER BY fraud_rate DESC, 1 LIMIT 15", "txn", round6="fraud_rate fraud_rate_pct"))
def _(spark, sf):
    return rounded(A.high_risk(txn(spark, sf, "card1", C.TARGET), "card1", 60, 15))


@query("missing_profile", check_sql(
    "SELECT feature, missing, pct FROM pct WHERE missing > 0", "txn", more=_MISSING, round6="pct"))
def _(spark, sf):
    return rounded(profile.missing_profile(txn(spark, sf)))


@query("missing_summary", check_sql(
    "SELECT count(*) AS n_features, count(*) FILTER (WHERE missing > 0) AS with_missing,"
    " count(*) FILTER (WHERE pct < 10) AS below_10_pct, count(*) FILTER (WHERE pct > 50) AS above_50_pct,"
    " count(*) FILTER (WHERE pct > 90) AS above_90_pct FROM pct", "txn", more=_MISSING))
def _(spark, sf):
    return profile.missing_summary(txn(spark, sf))


@query("eda_summary", check_sql(
    f"SELECT count(*) AS total_transactions, CAST({len(src.TXN_COLUMNS)} AS BIGINT) AS total_features,"
    " CAST(sum(isFraud) AS BIGINT) AS fraud_count, round(avg(isFraud) * 100, 2) AS fraud_rate_pct,"
    " round(median(TransactionAmt) FILTER (WHERE isFraud = 0), 2) AS median_amount_legit,"
    " round(median(TransactionAmt) FILTER (WHERE isFraud = 1), 2) AS median_amount_fraud,"
    " (SELECT count(*) FROM pct WHERE missing > 0) AS features_with_missing,"
    f" (SELECT hour FROM ({_HOURLY}) ORDER BY fraud_rate DESC, hour LIMIT 1) AS peak_fraud_hour,"
    " 'processed_parquet' AS data_source FROM txn", "txn", more=_MISSING))
def _(spark, sf):
    return profile.exploration_record(txn(spark, sf), "processed_parquet")


@query("time_span", check_sql(
    "SELECT min(TransactionDT) AS first_second, max(TransactionDT) AS last_second,"
    " CAST(round_even(max(TransactionDT) / 86400::DOUBLE, 0) AS BIGINT) AS days FROM txn", "txn"))
def _(spark, sf):
    return A.time_span(txn(spark, sf, C.TIME))


@query("time_span_files", check_sql(
    "SELECT min(TransactionDT) AS first_second, max(TransactionDT) AS last_second,"
    " CAST(round_even(max(TransactionDT) / 86400::DOUBLE, 0) AS BIGINT) AS days FROM txn", "txn"))
def _(spark, sf):
    """The span of a written table, from its footers."""
    path = sinks.write_parquet(txn(spark, sf, C.KEY, C.TIME), shared_dir(spark))
    return footers.from_footers(spark, A.time_span, path)


@query("peak_group", check_sql(
    f"SELECT 'hour' AS what, CAST(hour AS VARCHAR) AS top, n, fraud_rate FROM (SELECT * FROM ({_HOURLY})"
    " ORDER BY fraud_rate DESC, hour LIMIT 1) UNION ALL SELECT 'product', ProductCD, n, fraud_rate FROM"
    " (SELECT ProductCD, count(isFraud) AS n, avg(isFraud) AS fraud_rate FROM txn GROUP BY 1"
    " ORDER BY 3 DESC, 1 LIMIT 1)", "txn", round6="fraud_rate"))
def _(spark, sf):
    t = txn(spark, sf, C.TIME, "ProductCD", C.TARGET)
    hour = A.peak(t, X.hour_bin(C.TIME), "top").withColumn("what", F.lit("hour"))
    product = A.peak(t, F.col("ProductCD"), "top").withColumn("what", F.lit("product"))
    return rounded(hour.withColumn("top", F.col("top").cast("string")).unionByName(product))


# ---------------------------------------------------------------- statistics

def _outlier_sql(c):
    return (
        f"SELECT '{c}' AS feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_fence,"
        " q3 + 1.5 * (q3 - q1) AS upper_fence, count(*) FILTER (WHERE out) AS outliers,"
        " count(*) FILTER (WHERE out) * 100 / count(*) AS outlier_pct,"
        " coalesce(avg(isFraud) FILTER (WHERE out), 0) * 100 AS rate_outlier_pct,"
        " avg(isFraud) FILTER (WHERE NOT out) * 100 AS rate_inlier_pct FROM (SELECT isFraud, q1, q3,"
        f" coalesce({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1), false) AS out FROM txn,"
        f" (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM txn) q)"
        " GROUP BY q1, q3")


@query("iqr_outliers", check_sql(
    "\nUNION ALL\n".join(map(_outlier_sql, C.OUTLIER_COLUMNS)), "txn",
    round6="q1 q3 lower_fence upper_fence outlier_pct rate_outlier_pct rate_inlier_pct"))
def _(spark, sf):
    cols = C.OUTLIER_COLUMNS
    return rounded(stats.iqr_outliers(txn(spark, sf, *cols, C.TARGET), cols))


_CORR = [c for c in C.CORRELATION_COLUMNS if c in src.TXN_COLUMNS]
_V = [c for c in src.TXN_COLUMNS if c.startswith("V")]


def _corr_sql(pairs):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
        " AS corr FROM txn" for a, b in pairs)


@query("corr_matrix", check_sql(
    _corr_sql([(a, b) for i, a in enumerate(_CORR) for b in _CORR[i + 1:]]), "txn", round6="corr"))
def _(spark, sf):
    return rounded(stats.corr_matrix(txn(spark, sf, *_CORR), _CORR))


@query("corr_target", check_sql(
    f"SELECT feature_a AS feature, corr FROM ({_corr_sql([(c, 'isFraud') for c in _CORR[:-1]])})"
    " ORDER BY abs(corr) DESC, feature LIMIT 15", "txn", round6="corr"))
def _(spark, sf):
    return rounded(stats.corr_with_target(txn(spark, sf, *_CORR), _CORR[:-1], 15))


_STRONGEST = "SELECT feature_a AS feature, corr FROM known WHERE corr IS NOT NULL ORDER BY corr"


@query("corr_strongest", check_sql(
    f"SELECT *, 'positive' AS direction FROM ({_STRONGEST} DESC, feature LIMIT 1)"
    f" UNION ALL SELECT *, 'negative' FROM ({_STRONGEST}, feature LIMIT 1)", "txn", round6="corr",
    more=f"known AS ({_corr_sql([(c, 'isFraud') for c in _CORR[:-1]])})"))
def _(spark, sf):
    return rounded(stats.strongest_correlations(txn(spark, sf, *_CORR), _CORR[:-1]))


@query("corr_prefix_topk", check_sql(
    f"SELECT feature_a AS feature, corr FROM ({_corr_sql([(c, 'isFraud') for c in _V])})"
    " WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 20", "txn", round6="corr"))
def _(spark, sf):
    t = txn(spark, sf, *_V, C.TARGET)
    return rounded(stats.corr_with_target(t, stats.prefix_columns(t, "V"), 20))


@query("hist_log_amount", check_sql(
    "SELECT isFraud, bin, count(*) AS n, lo + bin * (hi - lo) / 50 AS left_edge,"
    " count(*) / (total * (hi - lo) / 50) AS density FROM (SELECT isFraud, lo, hi, total,"
    " least(49, CAST(floor((x - lo) / ((hi - lo) / 50)) AS BIGINT)) AS bin FROM"
    " (SELECT isFraud, ln(1 + TransactionAmt) AS x, min(ln(1 + TransactionAmt)) OVER w AS lo,"
    " max(ln(1 + TransactionAmt)) OVER w AS hi, count(*) OVER w AS total FROM txn"
    " WINDOW w AS (PARTITION BY isFraud))) GROUP BY isFraud, bin, lo, hi, total",
    "txn", round6="left_edge density"))
def _(spark, sf):
    t = txn(spark, sf, C.AMOUNT, C.TARGET)
    return rounded(stats.density_histogram(t, X.log_amount(C.AMOUNT)))


@query("boxplot_stats", check_sql(
    "SELECT isFraud, CASE isFraud WHEN 0 THEN 'Legitimate' ELSE 'Fraud' END AS label, q1, median, q3,"
    " count(*) AS n, min(x) FILTER (WHERE ok) AS whisker_low, max(x) FILTER (WHERE ok) AS whisker_high,"
    " count(*) FILTER (WHERE NOT ok) AS n_beyond FROM (SELECT t.isFraud, TransactionAmt AS x, q1, median,"
    " q3, TransactionAmt BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM txn t JOIN"
    " (SELECT isFraud, quantile_cont(TransactionAmt, 0.25) AS q1, median(TransactionAmt) AS median,"
    " quantile_cont(TransactionAmt, 0.75) AS q3 FROM txn WHERE TransactionAmt <= 1000 GROUP BY 1) q"
    " ON t.isFraud = q.isFraud WHERE TransactionAmt <= 1000) GROUP BY isFraud, q1, median, q3",
    "txn", round6="q1 median q3 whisker_low whisker_high"))
def _(spark, sf):
    return rounded(stats.box_plot(txn(spark, sf, C.AMOUNT, C.TARGET)))


# ---------------------------------------------------------------- splits, samples

@query("temporal_split", check_sql("SELECT TransactionID, TransactionDT, split FROM parts", "parts"))
def _(spark, sf):
    return splitting.mark_split(txn(spark, sf, C.KEY, C.TIME))


@query("split_summary", check_sql(
    "SELECT split, count(*) AS n_rows, min(TransactionDT) AS first_second, max(TransactionDT) AS last_second,"
    " CAST(round_even(avg(isFraud) * 1e4::DOUBLE, 0) AS DOUBLE) / 1e4 AS fraud_rate"
    " FROM parts GROUP BY split", "parts"))
def _(spark, sf):
    return splitting.split_summary(splitting.mark_split(txn(spark, sf, C.KEY, C.TIME, C.TARGET)))


@query("hash_sample")
def _(spark, sf):
    return hash_sample(txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET), C.REFERENCE_SAMPLE_ROWS, C.KEY, C.SEED)


@query("hash_sample_properties", check_sql(
    f"SELECT n, n AS n_keys, n AS n_found FROM (SELECT least(count(*), {C.REFERENCE_SAMPLE_ROWS}) AS n FROM txn)",
    "txn"))
def _(spark, sf):
    """Exact in size, no row twice, every row one of the table's."""
    t = txn(spark, sf, C.KEY, C.AMOUNT, C.TARGET)
    sample = hash_sample(t, C.REFERENCE_SAMPLE_ROWS, C.KEY, C.SEED)
    known = t.select(C.KEY, F.struct(C.AMOUNT, C.TARGET).alias("_row"))
    same = F.col("_row").eqNullSafe(F.struct(C.AMOUNT, C.TARGET))
    return sample.join(known, C.KEY, "left").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(C.KEY).alias("n_keys"), F.count_if(same).alias("n_found"))
