"""The analyses (``analyses``), chart series (``series``) and the keyed
query table used by ``__spark_entry__`` and ``bench.py`` (``registry``)."""
