"""DataFrame -> DataFrame operators (lazy, composable with ``df.transform``).

- ``clean``       C1-C5  codes, lenient casts, voided delays
- ``scale``       D1-D4  samples, N-fold copies, datasets of every size
- ``quality``     Q1-Q11 counts, distributions, profiles, null report, samples
- ``timechecks``  Q16-Q21 expected values, seven checks, report, bad rows, examples
- ``routes``      A1, A1b route and origin statistics
- ``bands``       A2 delay-band report (single pass) and its multi-step parts
- ``ranking``     A3, A3a carrier ranking (single pass), airport baseline, join form
- ``views``       I1-I4 inspection views over the results
"""
