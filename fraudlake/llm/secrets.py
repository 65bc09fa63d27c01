"""Secrets in texts, with the parts of a credential linked to each other.

Strong parts are reported always: ``assign`` (a secret word, a sign, a value of six or
more characters), ``access`` (access identifiers) and ``hex`` (24 or more hex digits).
Weak parts are reported only where a complementary part lies within ``SCOPE`` code
points: ``ident`` (user or client names; needs a strong secret), ``opaque`` (16 or more
mixed characters; needs an identifier) and ``endpoint`` (URLs and addresses; needs an
identifier and a secret). Only a part that is reported itself justifies another; a weak
part that overlaps a strong one is not reported. Reported parts with at most ``SCOPE``
code points between them are one credential and carry its number.

Only DataFrame functions. A text is split at each pattern's matches, so match i starts
after i gaps and i - 1 matches; the gaps become rows of their own and a running sum
turns them into positions. The interval join with complementary parts is a sort: the
nearest part of a kind is the one with the largest end before, or the smallest start
after. Rows of one text share a task; a text without any part is a single short row.

Every input row gives one output row; null is the empty text and has no spans;
repeated rows and repeated keys are told apart; an empty table gives an empty one. Spans
are code points, end exclusive.
"""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 256
VALUE = r"[A-Za-z0-9+/_.=-]"
RUN = r"[A-Za-z0-9+/_=-]"
ASSIGN = rf"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?({VALUE}+)"
#: kind, pattern, what a match must satisfy besides (an expression over ``m`` and ``v``)
KINDS = [
    ("assign", ASSIGN, "length(v) >= 6"),
    # a run that is too short holds no shorter one that is long enough
    ("access", r"AKIA[A-Z0-9]{16,}", "true"),
    ("hex", r"[0-9a-f]{24,}", "true"),
    ("opaque", rf"(?<!{RUN})(?=[A-Za-z+/_=-]*[0-9]){RUN}{{16,}}", "m rlike '[a-z]' and m rlike '[A-Z]'"),
    ("ident", rf"(?i)\b(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)[\"']?\x20*[:=]"
              rf"\x20*[\"']?[A-Za-z0-9@._-]{{3,}}", "true"),
    ("endpoint", r"(?i)\b(?:[a-z][a-z0-9+]{1,15}://[^\s\"'<>]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]+)?\b)", "true"),
]
NAMES = [k for k, _, _ in KINDS]
BASE = 3
FOUND = "__spans"  # a name of its own: documents may have a column "spans"


def _parts(text: str, number: int, pattern: str):
    """For each match its gap to the one before and its length, as rows to come. The three
    arrays are made once and zipped: nothing inside the lambdas looks at the text again."""
    body, lit = F.col(text), F.lit(pattern)
    found = F.regexp_extract_all(body, lit, F.lit(0))
    value = F.regexp_extract_all(body, lit, F.lit(2)) if number == 0 else F.lit(None)
    gaps = F.split(body, pattern, -1)
    # there is one more gap than there are matches: the last row has no match
    rows = F.transform(F.arrays_zip(gaps, found, *([value] if number == 0 else [])), lambda z, i: F.struct(
        F.lit(number).alias("kind"), i.alias("nth"), F.length(z["0"]).alias("gap"), F.length(z["1"]).alias("size"),
        F.octet_length(z["0"]).alias("gap_bytes"), F.octet_length(z["1"]).alias("bytes"), z["1"].alias("m"), (z["2"] if number == 0 else z["1"]).alias("v")))
    return F.when(body.rlike(pattern), F.filter(rows, lambda r: r["m"].isNotNull()))


def holds_part(text: str = "text"):
    """Whether any part, strong or weak, is in the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return reduce(lambda a, b: a | b, [body.rlike(p) for _, p, _ in KINDS])


def find(docs: DataFrame, text: str = "text", keep=("doc_id",), scope: int = SCOPE) -> DataFrame:
    """The columns in ``keep`` and ``FOUND``: array of (start, kind, end, credential, byte_start,
    byte_end, covered), in order of start, then kind (numbers as in ``NAMES``). Credentials are
    numbered from 1 in each text; ``covered`` is how far earlier spans reach, in bytes."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text), F.lit("")).alias("body"),
                       F.struct(*[F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]).alias("kept"))
    marker = "struct(-1 as kind, 0 as nth, 0 as gap, 0 as size, 0 as gap_bytes, 0 as bytes, '' as m, '' as v)"
    empty = f"filter(array({marker}), x -> false)"
    for n, (name, pattern, _) in enumerate(KINDS):
        rows = rows.withColumn(name, F.coalesce(_parts("body", n, pattern), F.expr(empty)))
    parts = (rows.withColumn("part", F.explode(F.concat(F.expr(f"array({marker})"), *[F.col(k) for k in NAMES])))
             .select("row", F.when(F.col("part.kind") == -1, F.col("kept")).alias("kept"), "part.*"))
    test = reduce(lambda w, x: w.when(F.col("kind") == x[0], F.expr(x[1][2])), enumerate(KINDS), F.when(
        F.col("kind") == -1, F.lit(True)))
    parts = parts.select("row", "kept", "kind", "nth", "gap", "size", "gap_bytes", "bytes", test.alias("good")).repartition("row")
    by_kind = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    parts = (parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(by_kind))
             .withColumn("byte_end", F.sum(F.col("gap_bytes") + F.col("bytes")).over(by_kind))
             .where("good").withColumn("start", F.col("end") - F.col("size")))

    forth = Window.partitionBy("row").orderBy("start", "kind")
    before = forth.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(name, one):
        return [F.max(F.when(one, F.col("end"))).over(before).alias(f"{name}_before"),
                F.min(F.when(one, F.col("start"))).over(after).alias(f"{name}_after")]

    def by(name):
        return F.coalesce((F.col("start") - F.col(f"{name}_before") <= scope)
                          | (F.col(f"{name}_after") - F.col("end") <= scope), F.lit(False))

    def kind(*names):
        return F.col("kind").isin(*[NAMES.index(n) for n in names])

    # only what is reported itself may justify another part: identifiers, then secrets, then endpoints
    parts = parts.select("*", *near("base", F.col("kind") < BASE), *near("strong", kind("assign", "hex")))
    apart = ~F.coalesce((F.col("base_before") > F.col("start")) | (F.col("base_after") < F.col("end")), F.lit(False))
    parts = parts.withColumn("reported", (F.col("kind") >= 0) & ((F.col("kind") < BASE) | (kind("ident") & apart & by(
        "strong")))).withColumn("apart", apart)
    parts = parts.select("*", *near("identifier", F.col("reported") & kind("access", "ident")))
    parts = parts.withColumn("reported", F.col("reported") | (kind("opaque") & F.col("apart") & by("identifier")))
    parts = parts.select("*", *near("secret", F.col("reported") & kind("assign", "hex", "opaque")))
    parts = parts.withColumn("reported", F.col("reported") | (
        kind("endpoint") & F.col("apart") & by("identifier") & by("secret")))

    # reported parts with at most ``scope`` between them are one credential
    opens = F.col("reported") & F.coalesce(F.col("start") - F.max(F.when(F.col("reported"), F.col("end"))).over(
        before) > scope, F.lit(True))
    covered = F.coalesce(F.max(F.when(F.col("reported"), F.col("byte_end"))).over(before), F.lit(0))
    parts = parts.withColumn("covered", covered).withColumn("opens", opens.cast("int")).withColumn("credential", F.sum("opens").over(
        forth.rowsBetween(Window.unboundedPreceding, 0)))
    span = F.when(F.col("reported"), F.struct(
        F.col("start").cast("int").alias("start"), "kind", F.col("end").cast("int").alias("end"),
        F.col("credential").cast("int").alias("credential"), (F.col("byte_end") - F.col("bytes")).cast("int").alias(
            "byte_start"), F.col("byte_end").cast("int").alias("byte_end"), F.col("covered").cast("int").alias("covered")))
    out = parts.groupBy("row").agg(F.first("kept", ignorenulls=True).alias("kept"),
                                   F.sort_array(F.collect_list(span)).alias(FOUND))
    return out.select(*[F.col(f"kept.keep_{i}").alias(c) for i, c in enumerate(keep)], FOUND)


def spelled(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in NAMES])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def linked(spans):
    """For each span the number of its credential, comma-joined in the same order."""
    return F.concat_ws(",", F.transform(spans, lambda s: s["credential"].cast("string")))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans as text, credentials as text)."""
    found = find(docs, text, (key,))

    def count(k):
        return F.size(F.filter(FOUND, lambda s: s["kind"] == k)).cast("long").alias(f"n_{NAMES[k]}")

    base = F.filter(FOUND, lambda s: s["kind"] < BASE)
    return found.select(key, *[count(k) for k in range(BASE)],
                        F.sha2(spelled(base).cast("binary"), 256).alias("base_sha256"),
                        spelled(F.col(FOUND)).alias("spans"), linked(F.col(FOUND)).alias("credentials"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by the mark; spans that meet share one.
    Texts without any part aren't moved."""
    quiet = docs.where(~holds_part(text))
    found = find(docs.where(holds_part(text)), text, tuple(docs.columns))
    raw = F.col(text).cast("binary")  # cutting bytes doesn't count characters from the start

    def piece(s):
        gap = F.substring(raw, s["covered"] + 1, F.greatest(F.lit(0), s["byte_start"] - s["covered"])).cast("string")
        fresh = (s["byte_start"] > s["covered"]) | (s["covered"] == 0)
        return F.concat(gap, F.when(fresh, F.lit(mark)).otherwise(F.lit("")))

    reach = F.array_max(F.transform(FOUND, lambda s: s["byte_end"]))
    whole = F.concat(F.concat_ws("", F.transform(FOUND, piece)),
                     F.substring(raw, reach + 1, F.octet_length(text)).cast("string"))
    clean = found.withColumn(text, F.when(F.size(FOUND) > 0, whole).otherwise(F.col(text)))
    return quiet.unionByName(clean.select(*docs.columns))
