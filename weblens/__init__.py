"""weblens: web-log and order analytics as Spark DataFrame / SQL / Structured
Streaming operators.

Packages: ``sources`` (readers), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame transforms), ``sinks`` (idempotent
writers), ``streaming`` (the order-counter stream), ``plans`` (end-to-end
jobs and the registered queries); ``cli`` runs the jobs under spark-submit.
"""

__version__ = "0.1.0"
