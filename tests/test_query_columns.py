from pyspark.sql.types import NumericType

from fraudlake.plans import queries_base, queries_model
from fraudlake.sources import adapter


def test_drift_queries_take_every_numeric_column(spark, sf):
    fields = adapter.transactions(spark, sf).schema.fields
    numeric = {f.name for f in fields if isinstance(f.dataType, NumericType)}
    features = numeric - {"TransactionID", "TransactionDT", "isFraud"}
    assert set(queries_model._DRIFT) == set(queries_model._W) == features
    assert set(queries_model._WINDOWED) == features - {"V4"}
    assert queries_base._V == [f.name for f in fields if f.name.startswith("V")]
