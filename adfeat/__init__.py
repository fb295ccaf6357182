"""Click and conversion features for ad-impression logs, written as Spark DataFrame plans.

Sub-packages:

* ``sources``   – impression schema, parquet/CSV readers, the fixture views, time split
* ``functions`` – native column expressions (list parsing, hour, digamma)
* ``operators`` – counts + attach, average time ranks, Beta-prior smoothing, profiles
* ``plans``     – the feature sets (history → target, within-frame) and the query registry
* ``streaming`` – the same count features maintained by Structured Streaming
"""

from adfeat.session import ensure_checkpoint_dir, get_spark, tune_session

__all__ = ["ensure_checkpoint_dir", "get_spark", "tune_session"]
