"""usagelens: user-activity analytics on Spark.

Application activity logs -> product metrics (DAU, WAU, feature usage) ->
one feature row per user -> segments and churn -> typed warehouse tables and
dashboard views, all as DataFrame / Spark SQL / MLlib jobs.
"""

__version__ = "0.1.0"
