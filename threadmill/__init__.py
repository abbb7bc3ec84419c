"""threadmill: training-corpus preparation expressed as Spark DataFrame plans.

Layout
------
functions/  Column -> Column expressions (text, scrub, messages, math answers, rewards)
operators/  DataFrame -> DataFrame operators (dedup, ranking/splits, quality, stats, joins)
sources/    scans and sinks (parquet, JSONL, CSV, layout sinks)
plans/      fixture derivations over the driver tables and the registered queries
streaming/  Structured Streaming jobs (step-log tail, incremental clean/dedup, snapshots)
"""

from threadmill.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
