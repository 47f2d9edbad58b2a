"""labelloop: label-feedback analytics on Spark DataFrames.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column rules),
``operators`` (DataFrame → DataFrame operators), ``plans`` (composite jobs,
fixture views, the query catalog) and ``streaming`` (incremental forms).
"""

__version__ = "0.1.0"
