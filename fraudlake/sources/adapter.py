"""Views that give the supplied tables the shape of card transactions.

The same SQL text runs on Spark and on the checking engine; only the time
difference and the JSON access are spelled differently.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DT = {
    "spark": "timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)",
    "check": "date_diff('second', timestamp '2024-01-01 00:00:00', ts)",
}
_K = {
    # props holds one number, {"k": n}; taking the digits costs a third of a JSON parse
    "spark": r"""cast(regexp_extract(props, '"k": *(-?[0-9]+)', 1) as bigint)""",
    "check": "cast(json_extract_string(props, '$.k') as bigint)",
}
_BASE = ("SELECT event_id, ts, {dt} AS dt, value, event_type, user_id, {k} AS k FROM {events}")

_COLUMNS = {
    "TransactionID": "event_id",
    "TransactionDT": "dt",
    "TransactionAmt": "value",
    "isFraud": "CASE WHEN (value > 80 AND k < 25) OR k = 97 THEN 1 ELSE 0 END",
    "ProductCD": "event_type",
    "card1": "user_id",
    "addr1": "CASE WHEN k % 9 = 0 THEN NULL ELSE k END",
    "card4": "c_mktsegment",
    "card6": "CASE WHEN k % 13 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'credit' ELSE 'debit' END",
    "P_emaildomain": "CASE WHEN k % 6 = 0 THEN NULL WHEN k % 6 = 1 THEN 'yahoo.com'"
                     " WHEN k % 6 = 2 THEN 'aol.com' WHEN user_id % 7 = 0 THEN 'mail.com'"
                     " ELSE 'gmail.com' END",
    "R_emaildomain": "CASE WHEN k % 4 <> 0 THEN NULL WHEN user_id % 2 = 0 THEN 'gmail.com'"
                     " ELSE 'yahoo.com' END",
    "dist1": "CASE WHEN k % 2 = 0 THEN NULL ELSE value * k / 100 END",
    "C1": "CAST(k % 7 AS DOUBLE)",
    "C2": "CAST(k % 11 AS DOUBLE)",
    "C3": "CAST(k % 3 AS DOUBLE)",
    "C4": "CAST((k * 3) % 17 AS DOUBLE)",
    "C5": "CAST(user_id % 5 AS DOUBLE)",
    "C6": "CAST(k % 13 AS DOUBLE)",
    "D1": "CAST(CASE WHEN k % 5 = 0 THEN NULL ELSE k * 2 END AS DOUBLE)",
    "D10": "CAST(CASE WHEN k % 4 = 0 THEN NULL ELSE k + user_id % 10 END AS DOUBLE)",
    "D15": "CAST(CASE WHEN k % 10 <> 0 THEN NULL ELSE 100 - k END AS DOUBLE)",
    "V1": "CAST(k % 2 AS DOUBLE)",
    "V2": "CASE WHEN k % 10 = 9 THEN NULL ELSE value / 10 END",
    "V3": "value - k",
    "V4": "CAST(NULL AS DOUBLE)",
}
TXN_COLUMNS = list(_COLUMNS)
TEXT_COLUMNS = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]


def txn_sql(engine: str, events: str = "events", customer: str = "customer",
            columns: list[str] | None = None, time: bool = False) -> str:
    """Transactions as SQL text. The customer table is joined for ``card4`` only."""
    columns = columns or TXN_COLUMNS
    base = _BASE.format(dt=_DT[engine], k=_K[engine], events=events)
    items = ", ".join(f"{_COLUMNS[c]} AS {c}" for c in columns) + (", ts" if time else "")
    join = f" LEFT JOIN {customer} c ON user_id = c.c_custkey" if "card4" in columns else ""
    return f"SELECT {items} FROM ({base}) e{join}"


def identity_sql(engine: str, events: str = "events") -> str:
    return (f"SELECT event_id AS TransactionID, CAST(-{_K[engine]} AS DOUBLE) AS id_01,"
            " CASE WHEN user_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType"
            f" FROM {events} WHERE event_id % 4 = 0")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, *columns: str, time: bool = False) -> DataFrame:
    return transactions_of(
        table(spark, sf_dir, "events"),
        table(spark, sf_dir, "customer") if not columns or "card4" in columns else None,
        *columns, time=time)


def transactions_of(events: DataFrame, customer: DataFrame | None, *columns: str,
                    time: bool = False) -> DataFrame:
    """Same view over any events frame, also a streaming one."""
    sql = txn_sql("spark", "{events}", "{customer}", list(columns), time)
    frames = {"events": events, "customer": customer}
    return events.sparkSession.sql(sql, **{k: v for k, v in frames.items() if "{" + k + "}" in sql})


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(identity_sql("spark", "{events}"), events=table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Transactions with a reproducible score that carries some signal."""
    columns = list(dict.fromkeys(["TransactionID", "isFraud", *columns]))
    return transactions(spark, sf_dir, *columns).withColumn("score", F.expr(SCORE_SQL))


SCORE_SQL = ("0.7 * (cast((TransactionID * 7919) % 1000 as double) / 1000)"
             " + 0.3 * cast(isFraud as double)")
