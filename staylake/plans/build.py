"""Build every model as a Parquet table (the model run).

Staging, dimension and fact models, the three marts and the four questions
are written under one folder, one sub-folder per model; each write is one
Spark job over the raw tables.
"""

from __future__ import annotations

import os
from typing import Callable, Sequence

from pyspark.sql import DataFrame

from staylake.plans import marts, questions
from staylake.plans.warehouse import Warehouse

MODELS: dict[str, Callable[[Warehouse], DataFrame]] = {
    **{name: (lambda n: lambda wh: getattr(wh, n)())(name) for name in Warehouse.MODELS},
    "dm_host_neighbourhood": marts.dm_host_neighbourhood,
    "dm_listing_neighbourhood": marts.dm_listing_neighbourhood,
    "dm_property_type": marts.dm_property_type,
    "q1_best_worst": questions.q1_best_worst,
    "q2_best_type": questions.q2_best_type,
    "q3_local_rate": questions.q3_local_rate,
    "q4_mortgage_cover": questions.q4_mortgage_cover,
}


def build_models(wh: Warehouse, out_dir: str, names: Sequence[str] | None = None) -> dict[str, str]:
    """Write the chosen models (default: all) and return their locations."""
    written = {}
    for name in names or MODELS:
        path = os.path.join(out_dir, name)
        MODELS[name](wh).write.mode("overwrite").parquet(path)
        written[name] = path
    return written
