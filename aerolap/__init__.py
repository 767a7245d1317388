"""aerolap: airline on-time analytics as lazy Spark DataFrame operators.

Layout:
- ``schema``     declared schemas and the fixed vocabularies;
- ``functions``  Column -> Column expressions (clock arithmetic, bands, codes);
- ``sources``    CSV / Parquet / table sources and sinks, paths, test fixture;
- ``operators``  DataFrame -> DataFrame operators (cleaning, scaling, quality
                 checks, the three analyses, inspection views);
- ``plans``      the query registry, oracle SQL and plan inspection.
"""

__version__ = "0.1.0"
