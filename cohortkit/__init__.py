"""Spark-native patient-cohort derivation.

Layers:

* ``cohortkit.functions`` - Column builders (coercion, dates, buckets, status);
* ``cohortkit.operators`` - DataFrame transforms (harmonise, rules, windows, dedup);
* ``cohortkit.sources``   - CSV extracts, the test fixture, sinks;
* ``cohortkit.plans``     - the end-to-end plan;
* ``cohortkit.streaming`` - the per-row rules on a streaming source.
"""

from cohortkit.plans.cohort import cohort, run

__all__ = ["cohort", "run"]
