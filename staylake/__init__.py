"""staylake: short-stay rental analytics on Spark DataFrames.

Layers
------
functions/  column expressions (exact rounding, dates, occupancy estimates)
operators/  reusable DataFrame operators (KPIs, windows, history, joins, checks)
sources/    feed schemas, loaders, sinks and the test-table fixture
plans/      the staging / warehouse / mart / question models
streaming/  incremental feed ingestion with Structured Streaming

The usual entry points are importable from the package itself::

    from staylake import get_session, load_feeds, Warehouse, marts, questions
"""

__version__ = "0.1.0"

from staylake.plans import marts, questions  # noqa: E402
from staylake.plans.build import build_models  # noqa: E402
from staylake.plans.warehouse import Warehouse  # noqa: E402
from staylake.session import cluster_conf, get_session  # noqa: E402
from staylake.sources.feeds import load_feeds  # noqa: E402

__all__ = ["Warehouse", "build_models", "cluster_conf", "get_session", "load_feeds",
           "marts", "questions"]
