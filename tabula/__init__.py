"""tabula - labelled-vector analytics on Spark.

Sub-packages: ``sources`` (readers, sinks), ``functions`` (column
expressions and per-image numpy helpers), ``operators`` (DataFrame ->
DataFrame operators), ``plans`` (preparation, models, scoring, end-to-end
runs), ``streaming`` (the scoring stream). ``registry`` holds the queries
exposed to the driver.
"""

__version__ = "0.1.0"
