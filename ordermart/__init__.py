"""ordermart: e-commerce order analytics as lazy Spark DataFrame operators.

Layers (raw -> bronze -> silver -> gold), all DataFrame-to-DataFrame:

* ``sources``    declared schemas, CSV/Parquet readers, test-table adapter
* ``functions``  column expressions (recodes, bands, flags, money rounding)
* ``operators``  cleaning, pre-aggregation, the wide order-item table,
                 features, customer segments, KPIs and data-quality reports
* ``plans``      physical controls: size-checked broadcast, partitioning,
                 sinks, lineage cuts, plan inspection
* ``streaming``  incremental (file-stream) bronze ingest of landing files
"""

__version__ = "0.1.0"
