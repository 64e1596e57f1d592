"""ratecraft — customer credit-style scoring on Spark.

Layout
------
sources/    readers, writers, schemas, model store, source profile
functions/  Column-expression builders (ratios, rules, score maps, hash split)
operators/  DataFrame-in / DataFrame-out operators (bounds, quantiles,
            cumulative sums, evaluation curves, joins, scaling, indexing)
plans/      the application: feature table, five views, models, jobs,
            and the query registry used by ``__spark_entry__``
"""

__version__ = "0.1.0"
