"""crashlens: product-stability reporting on per-session telemetry, built on Spark.

The library is a set of DataFrame -> DataFrame functions:

* ``sources``   raw ping scans, the test-fixture mapping, published-report readers and writers
* ``operators`` cleaning, the profile-day rollup, report calendar, weekly metrics,
                crash-gap history, new-profile cohort, summary assembly, chart series
* ``functions`` column-expression helpers (dates, crash counts, rates, statistics)
* ``plans``     the end-to-end report job and the durable profile-day table
* ``streaming`` an incremental (available-now) driver over a growing ping folder
"""

from crashlens.params import ReportParams

__all__ = ["ReportParams"]
