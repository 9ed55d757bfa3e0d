"""``python -m strataflow.verify ROOT``: the checks of a built warehouse; the exit status is 1 if one fails."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from strataflow.config import DEFAULT, WarehouseConfig
from strataflow.plans.warehouse import Warehouse, verification
from strataflow.session import build_session


def run(spark: SparkSession, root: str, cfg: WarehouseConfig = DEFAULT) -> int:
    """Print every verdict; 0 if all checks passed, else 1."""
    house = Warehouse(spark, root)
    verdicts = verification(house, cfg, house.read("audit", "etl_log")).collect()
    for row in sorted(verdicts, key=lambda r: (r.passed, r.check_name)):
        print(f"{'pass' if row.passed else 'FAIL'}  {row.check_name}: {row.observed}")
    return 0 if all(row.passed for row in verdicts) else 1


if __name__ == "__main__":
    if len(sys.argv) != 2:
        sys.exit(__doc__)
    sys.exit(run(build_session("verify"), sys.argv[1]))
