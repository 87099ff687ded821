"""panelspark — entity × period panel analytics as Spark DataFrame jobs.

Layout:
  functions/  column expressions (keys, numbers, text, rules, geo)
  operators/  DataFrame → DataFrame operators (clean, joins, aggregates,
              windows, ordering, reshape, knn, features, models, cluster)
  sources/    landing readers and sinks
  plans/      compositions (enrichment, modelling, imputation) and the
              fixture views built from the shared test tables
  streaming/  incremental landing of the daily exposure builder
"""

__version__ = "0.1.0"
