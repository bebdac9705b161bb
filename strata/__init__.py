"""strata: Spark-native re-expression of a portfolio of institutional SQL jobs.

Layout: ``sources`` (readers, stand-ins, sinks), ``functions`` (column
expressions), ``operators`` (multi-step DataFrame operators), ``plans`` (the
composed jobs), ``streaming`` (incremental runner), ``registry`` (one Spark
query and one oracle SQL per surveyed operator).
"""
