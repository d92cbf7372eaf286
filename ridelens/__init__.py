"""ridelens: trip analytics as Spark DataFrame plans.

Layout: ``sources`` (readers, sinks, test-table views), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (the analyses and chart series), ``streaming`` (the same plans over
a growing folder of trip files).
"""

from ridelens.session import build_session, object_store_conf, pin_session, scratch_dir

__all__ = ["build_session", "object_store_conf", "pin_session", "scratch_dir"]
