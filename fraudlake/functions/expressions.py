"""Column expressions. All run inside the JVM; none is a Python function per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_even(x, digits: int) -> Column:
    """Scale, round half to even, scale back, as numeric array libraries do."""
    return F.rint(col(x) * float(10 ** digits)) / float(10 ** digits)


def share(part, whole) -> Column:
    """Ratio that is 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(col(part).cast("double"), col(whole).cast("double")), F.lit(0.0))


def log_amount(x) -> Column:
    return F.log1p(col(x))


def thousandths(x) -> Column:
    """Thousandths of the fractional part, truncated; keeps the sign."""
    return ((col(x) - col(x).cast("long")) * 1000).cast("long")


def hour_of_day(dt) -> Column:
    """Fractional hour in [0, 24); also for times before the origin."""
    return F.pmod(col(dt) / F.lit(3600.0), F.lit(24.0))


def day_of_week(dt) -> Column:
    return F.pmod(col(dt) / F.lit(86400.0), F.lit(7.0))


def hour_bin(dt) -> Column:
    return F.floor(hour_of_day(dt)).cast("long")


def right_closed_bin(x, edges: list[float]) -> Column:
    """Index of the bin (edges[i], edges[i+1]] that holds x, else null."""
    x, chain = col(x), F.when(F.lit(False), F.lit(None).cast("int"))
    chain = chain.when(x <= F.lit(float(edges[0])), F.lit(None).cast("int"))
    for i, hi in enumerate(edges[1:]):
        chain = chain.when(x <= F.lit(float(hi)), F.lit(i))
    return chain


def bin_label(index, labels: list[str]) -> Column:
    return F.try_element_at(F.array(*map(F.lit, labels)), col(index) + 1)


def class_label(target=C.TARGET) -> Column:
    return F.when(col(target) == 0, "Legitimate").when(col(target) == 1, "Fraud")


def risk_band(p) -> Column:
    """Band of the whole-number percentage (rounded half up)."""
    pct = F.floor(col(p) * 100 + 0.5)
    return F.when(pct >= 70, "high").when(pct >= 40, "medium").otherwise("low")


def score_columns(p, threshold: float = C.SCORE_THRESHOLD) -> dict[str, Column]:
    """Reported probability, decision on the unrounded probability, confidence."""
    p = col(p)
    return {
        "fraud_probability": half_even(p, 4),
        "is_fraud": p >= threshold,
        "confidence": half_even(F.greatest(p, 1 - p), 4),
    }


def with_payload_defaults(df: DataFrame, payload: str, defaults: dict = C.REQUEST_DEFAULTS,
                          more: dict[str, str] | None = None) -> DataFrame:
    """Replace the JSON text column by the declared request fields, absent ones
    filled with their default; ``extras`` keeps every other field as text. With ``more`` (names
    and types) these other fields only are read, as columns in place of ``extras``: comparing every field
    of a payload with every declared name costs more than parsing it. The text
    is parsed once, in a step of its own, and all numbers are cast as one array in another: a cast
    for each field makes a method of the generated code that the JVM only interprets."""
    others = [c for c in df.columns if c != payload]
    parsed = df.select(*others, F.from_json(payload, "map<string,string>").alias("_fields"))
    names = F.array(*map(F.lit, defaults))
    kinds = {n: "string" if isinstance(d, str) else "double" for n, d in defaults.items()} | (more or {})
    numbers = [n for n, kind in kinds.items() if kind == "double"]
    if more is None:
        rest = [F.map_filter("_fields", lambda k, _: ~F.array_contains(names, k)).alias("_extras")]
    else:
        rest = []
    texts = [field(n).try_cast(kind).alias("_" + n) for n, kind in kinds.items() if kind != "double"]
    read = parsed.select(*others, F.array(*map(field, numbers)).try_cast("array<double>").alias("_numbers"),
                         *texts, *rest)

    def value(n):
        found = F.get("_numbers", F.lit(numbers.index(n))) if n in numbers else F.col("_" + n)
        return (F.coalesce(found, F.lit(defaults[n])) if n in defaults else found).alias(n)

    return read.select(*others, *map(value, kinds), *[F.col("_extras").alias("extras") for _ in rest])


def field(name: str) -> Column:
    """Text of one field of a parsed payload."""
    return F.try_element_at("_fields", F.lit(name))


def payload_key(columns: list[str]) -> Column:
    """Same key for the same field values, whatever order they came in."""
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.concat(F.lit("pred:"), F.sha2(text, 256))
