"""python -m fraudlake STAGE --root DIR --transactions CSV [--identity CSV]"""

import argparse

from .plans.stages import STAGES, Workspace, monitor
from .session import build_session


def main():
    p = argparse.ArgumentParser(description="Run one stage of the fraud analytics batch.")
    p.add_argument("stage", choices=list(STAGES))
    p.add_argument("--root", required=True, help="output folder all executors can reach")
    p.add_argument("--transactions", required=True, help="transaction CSV")
    p.add_argument("--identity", help="identity CSV, optional")
    p.add_argument("--model", default="gbt", choices=["gbt", "random-forest", "logistic-regression"])
    p.add_argument("--current", default="test", help="table to monitor")
    a = p.parse_args()
    ws = Workspace(build_session(), a.root, a.transactions, a.identity, a.model)
    result = monitor(ws, a.current) if a.stage == "monitor" else STAGES[a.stage](ws)
    if result is not None:
        result.show(truncate=False)


if __name__ == "__main__":
    main()
