import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from fraudlake.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def raw(spark):
    """A few weeks of invented transactions: repeated amounts, ties in time, gaps in most
    columns and one column without any value."""
    import random

    r, rows = random.Random(20), []
    for i in range(100):
        def maybe(value, share=0.2):
            return None if r.random() < share else value

        rows.append((
            i, r.randrange(21) * 86_400 + r.choice([0, 3_600, 40_000, r.randrange(86_400)]),
            r.choice([9.99, 25.0, round(r.uniform(1, 400), 2)]), int(r.random() < 0.15),
            r.choices("WCRHS", [6, 2, 1, 1, 1])[0], float(2_000 + r.randrange(12)), maybe(150.0 + r.randrange(4)),
            maybe(r.choice(["visa", "mastercard"])), maybe(r.choice(["debit", "credit"])),
            maybe(float(r.choice([87, 204, 325]))), maybe(r.choice(["mail.example", "post.example"]), 0.4),
            float(r.randrange(7)), maybe(float(r.choice([0, 2, 30]))), None))
    schema = ("TransactionID long, TransactionDT long, TransactionAmt double, isFraud long, ProductCD string,"
              " card1 double, card2 double, card4 string, card6 string, addr1 double, P_emaildomain string,"
              " C1 double, D1 double, D2 double")
    return spark.createDataFrame(rows, schema).cache()
