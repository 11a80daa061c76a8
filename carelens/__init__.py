"""carelens: facility staffing analytics as Spark DataFrame / SQL operators.

Layers: landing CSV -> bronze (clean, retain, stamp) -> gold (joins + derived
staffing metrics) -> dashboard questions (cascaded filters, per-facility
roll-up, top-k views).  Every operator is a pure ``DataFrame -> DataFrame``
function built from native Column / SQL expressions, so Catalyst can prune,
push down and whole-stage-codegen the whole chain.

Main entry points::

    from carelens import get_spark, bronze_staffing, bronze_provider, bronze_state, gold, dashboard
    from carelens import run_bronze, run_gold, ask, load_gold        # file-to-file runner
"""

__version__ = "0.1.0"

from carelens.plans.bronze import bronze_provider, bronze_staffing, bronze_state  # noqa: E402
from carelens.plans.dashboard import dashboard, load_for_dashboard  # noqa: E402
from carelens.plans.gold import gold, gold_via_sql  # noqa: E402
from carelens.plans.runner import ask, load_gold, run_bronze, run_gold  # noqa: E402
from carelens.session import apply_cluster_conf, get_spark  # noqa: E402
from carelens.streaming.incremental import gold_incremental, ingest_incremental  # noqa: E402

__all__ = [
    "apply_cluster_conf", "ask", "bronze_provider", "bronze_staffing", "bronze_state", "dashboard", "get_spark",
    "gold", "gold_incremental", "gold_via_sql", "ingest_incremental", "load_for_dashboard", "load_gold",
    "run_bronze", "run_gold",
]
