"""strata: layered (raw -> conformed -> mart) batch analytics on Spark.

Every operator is a plain DataFrame -> DataFrame (or Column -> Column)
function built from ``pyspark.sql.functions``; Catalyst plans the work.

Where to start:

* ``strata.plans.layers.run_layers`` - land, conform, build marts, with a
  quality gate after each written layer;
* ``strata.operators`` - ``conform_table``, ``dedup_by_key``, the four marts,
  ``check_tables`` / ``check_layer`` and the quality rules;
* ``strata.functions.columns`` - tolerant casts and text normalisation;
* ``strata.sources`` - raw CSV reading/writing, ``LayerStore``;
* ``strata.streaming.landing`` - incremental raw landing;
* ``python -m strata`` - the same jobs from the command line.
"""

__version__ = "0.1.0"
