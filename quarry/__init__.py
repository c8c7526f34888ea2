"""quarry: a PySpark-native batch ELT and star-schema analytics library.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a
``Column``) built on Spark's own expressions, so plans stay inside Catalyst
and whole-stage codegen.  Sub-packages:

- ``quarry.sources``    CSV extract, inline seed rows, driver-table views
- ``quarry.functions``  Column helpers (safe percentage, calendar, patterns)
- ``quarry.operators``  clean, keys, merge, facts, analytics, quality
- ``quarry.plans``      the ELT pipeline, catalog-backed warehouse, driver queries
- ``quarry.streaming``  incremental (file-stream) form of the extract/stage step
"""

__version__ = "0.1.0"

from quarry.operators.analytics import (  # noqa: E402
    filtered_sum,
    rank_and_lag,
    ratio_having,
    sessionize,
    top_n_per_group,
)
from quarry.operators.quality import gate, run_checks, validate  # noqa: E402
from quarry.plans.elt import run_elt  # noqa: E402
from quarry.plans.warehouse import Warehouse  # noqa: E402

__all__ = [
    "Warehouse",
    "filtered_sum",
    "gate",
    "rank_and_lag",
    "ratio_having",
    "run_checks",
    "run_elt",
    "sessionize",
    "top_n_per_group",
    "validate",
]
