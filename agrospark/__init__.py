"""agrospark: Spark-native agronomic planning operators.

Every public operator is a function ``DataFrame -> DataFrame`` (chainable with
``df.transform``) built from Spark's own joins, windows, aggregates and
higher-order functions.  Sub-packages:

* ``functions``  column expressions (text repair, rounding, dates, arrays, draws)
* ``sources``    readers and writers (CSV variants, JSON payloads, HTML boards,
                 polygon rings, distance matrices, sinks)
* ``operators``  table operators (cleaning, joins, climate windows, geo,
                 prices, feature widening, knapsack, tours, evolution, models)
* ``plans``      the registered queries over the driver tables + oracle SQL
* ``streaming``  Structured Streaming roll-ups
"""

__version__ = "0.1.0"
