"""The standard reports over the analytic table, all from one scan of it.

``report_counts`` groups the table by every report's keys at once (grouping sets: one
scan, one Expand, one shuffle of partial sums) and writes the result, a row per group.
Each report is then a small selection from that table, so further reports cost no scan.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import bin_label, hour_bin, right_closed_bin
from ..session import materialize

MEAN_COLUMNS = [f"C{i}" for i in range(1, 7)]
_KEYS = ["ProductCD", "card4", "card6", "_class", "_bin", "_hour"]
_SETS = [["ProductCD"], ["card4"], ["card6"], ["_class"], ["_bin"], ["_hour"], ["_hour", "_class"], []]


def _number(keys: list[str], of: list[str]) -> int:
    """``grouping_id`` of a set: a bit for each key that it leaves out, the first key highest."""
    return sum(1 << (len(of) - 1 - i) for i, k in enumerate(of) if k not in keys)


def report_counts(table: DataFrame) -> DataFrame:
    """Sums of every group of every report. A key that the table lacks has no groups; a null
    key is a group of its own, apart from the groups that leave the key out."""
    made = {"_class": F.col(C.TARGET)}
    if C.AMOUNT in table.columns:
        made["_bin"] = right_closed_bin(C.AMOUNT, C.AMOUNT_EDGES)
    if C.TIME in table.columns:
        made["_hour"] = hour_bin(C.TIME)
    keyed = table.withColumns(made)
    keys = [k for k in _KEYS if k in keyed.columns]
    sets = [s for s in _SETS if set(s) <= set(keys)]
    amount = [f(C.AMOUNT).alias(n) for f, n in (
        (F.avg, "avg_amount"), (F.min, "min_amount"), (F.max, "max_amount")) if C.AMOUNT in table.columns]
    return keyed.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("txn_count"), F.count(C.TARGET).alias("n"),
        F.sum(C.TARGET).alias("fraud_count"), F.avg(C.TARGET).alias("fraud_rate"), *amount,
        *[F.avg(c).alias("mean_" + c) for c in MEAN_COLUMNS if c in table.columns])


class Reports:
    """The reports of one table; the table is read once, when this is made."""

    def __init__(self, table: DataFrame):
        self.counts = materialize(report_counts(table))
        self._keys = [k for k in _KEYS if k in self.counts.columns]

    def _of(self, *keys: str) -> DataFrame:
        return self.counts.where(F.col("_set") == _number(list(keys), self._keys))

    def rate_by(self, group: str, with_positives: bool = True) -> DataFrame:
        return self._of(group).select(
            group, "txn_count", *(["fraud_count"] if with_positives else []),
            _percent().alias("fraud_rate_pct")).orderBy(F.desc("fraud_rate_pct"), group)

    def amount_by_class(self) -> DataFrame:
        return self._of("_class").select(F.col("_class").alias(C.TARGET), "txn_count", *[
            F.round(c, 2).alias(c) for c in ("avg_amount", "min_amount", "max_amount")])

    def means_by_class(self) -> DataFrame:
        means = [c for c in self.counts.columns if c.startswith("mean_")]
        return self._of("_class").select(
            F.col("_class").alias(C.TARGET), *[F.round(c, 4).alias(c[len("mean_"):]) for c in means])

    def overall(self) -> DataFrame:
        """One row, also for an empty table, which has no group at all."""
        one = self.counts.sparkSession.range(0, 1, 1, 1).select(F.lit(0).alias("_one"))
        return one.join(F.broadcast(self._of().withColumn("_one", F.lit(0))), "_one", "left").select(
            F.coalesce("txn_count", F.lit(0)).alias("total_rows"), F.col("fraud_count").alias("total_fraud"),
            _percent().alias("fraud_rate_pct"), F.round("avg_amount", 2).alias("avg_amount"))

    def rate_by_amount_bin(self) -> DataFrame:
        return self._of("_bin").where("_bin IS NOT NULL").select(
            F.col("_bin").alias("bin"), bin_label("_bin", C.AMOUNT_LABELS).alias("label"), "n", "fraud_count",
            "fraud_rate", (F.col("fraud_rate") * 100).alias("fraud_rate_pct")).orderBy("bin")

    def rate_by_hour(self) -> DataFrame:
        return self._of("_hour").where("_hour IS NOT NULL").select(
            F.col("_hour").alias("hour"), "n", "fraud_count", "fraud_rate").orderBy("hour")

    def hour_class_counts(self) -> DataFrame:
        def of(v):
            return F.sum(F.when(F.col("_class") == v, F.col("txn_count")).otherwise(0))
        return (self._of("_hour", "_class").where("_hour IS NOT NULL").groupBy(F.col("_hour").alias("hour"))
                .agg(of(0).alias("legitimate"), of(1).alias("fraud")).orderBy("hour"))

    def product_share(self, group: str = "ProductCD") -> DataFrame:
        whole = self._of().select(F.col("txn_count").alias("_rows"))  # one row
        return (self._of(group).where(F.col(group).isNotNull()).join(F.broadcast(whole))
                .select(group, "n", "fraud_count", "fraud_rate", (F.col("fraud_rate") * 100).alias("fraud_rate_pct"),
                        (F.col("n") * 100 / F.col("_rows")).alias("pct_of_total"))
                .orderBy(F.desc("n"), group))

    def rate_topk(self, group: str, k: int) -> DataFrame:
        whole = self._of().select(F.col("fraud_rate").alias("_rate"))  # one row
        return (self._of(group).where(F.col(group).isNotNull()).join(F.broadcast(whole))
                .select(F.col(group).alias("category"), "n", "fraud_rate",
                        (F.col("fraud_rate") > F.col("_rate")).alias("above_overall"))
                .orderBy(F.desc("n"), "category").limit(k))


def _percent() -> Column:
    return F.round(F.col("fraud_rate") * 100, 2)


def run_reports(table: DataFrame) -> dict[str, DataFrame]:
    reports = Reports(table)
    return {
        "fraud_rate_by_product": reports.rate_by("ProductCD"),
        "amount_by_fraud": reports.amount_by_class(),
        "fraud_rate_by_card_type": reports.rate_by("card6", with_positives=False),
        "c_features_fraud_vs_legit": reports.means_by_class(),
        "summary": reports.overall(),
    }
