"""lodgelake: monthly short-term-rental analytics as Spark DataFrame functions.

Layers (all lazy DataFrames unless written by ``plans.build``):

* ``sources``   -- raw source schemas, readers, the scrape view over the supplied tables, sinks
* ``functions`` -- column expressions: cleaning, dates, hashed keys, exact decimal rounding
* ``operators`` -- DataFrame -> DataFrame operators: top-per-group, calendar, SCD2,
                   point-in-time join, priority lookup, exact median, size-checked broadcast
* ``plans``     -- the bronze / silver / snapshot / star / mart relations wired together
"""

__version__ = "0.1.0"
