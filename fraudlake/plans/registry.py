"""The named queries and, where SQL can say the same, the SQL they are checked with."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.adapter import SCORE_SQL, identity_sql, txn_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
DIGITS = 6


def query(name: str, check: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return add


def rounded(df: DataFrame, *skip: str) -> DataFrame:
    """Round the doubles: sums of floating numbers depend on their order."""
    return df.select(*[
        (F.round(f.name, DIGITS) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) and f.name not in skip else f.name
        for f in df.schema])


_SPLIT_RANK = "CAST(trunc(count(*) OVER () * 0.8::DOUBLE) AS BIGINT)"
VIEWS = {
    "txn": txn_sql("check"),
    "ident": identity_sql("check"),
    "scored": f"SELECT *, {SCORE_SQL} AS score FROM txn",
    "parts": "SELECT *, CASE WHEN row_number() OVER (ORDER BY TransactionDT, TransactionID) <= "
             f"{_SPLIT_RANK} THEN 'train' ELSE 'test' END AS split FROM txn",
    "train": "SELECT * EXCLUDE (split) FROM parts WHERE split = 'train'",
    "test": "SELECT * EXCLUDE (split) FROM parts WHERE split = 'test'",
}
_NEEDS = {"txn": [], "ident": [], "scored": ["txn"], "parts": ["txn"],
          "train": ["txn", "parts"], "test": ["txn", "parts"]}


def check_sql(body: str, *views: str, more: str = "", round6: str = "") -> str:
    """SQL over the adapter views; ``more`` adds further WITH items, ``round6``
    lists the columns rounded like ``rounded`` does."""
    names = []
    for v in views:
        for n in (*_NEEDS[v], v):
            if n not in names:
                names.append(n)
    items = [f"{n} AS ({VIEWS[n]})" for n in names] + ([more] if more else [])
    if round6:
        cols = ", ".join(f"round({c}, {DIGITS}) + 0.0::DOUBLE AS {c}" for c in round6.split())
        body = f"SELECT * REPLACE ({cols}) FROM ({body}) result"
    recursive = "RECURSIVE " if "RECURSIVE" in more else ""
    items = [i.replace("RECURSIVE ", "") for i in items]
    return ("WITH " + recursive + ",\n".join(items) + "\n" if items else "") + body
