"""churnlake: subscription-churn analytics as Spark DataFrame jobs.

Every operator is a parameterised ``DataFrame -> DataFrame`` function.
Sub-packages:

* ``sources``   -- scans, sinks and the adapters from the driver tables to the
                   churn domain tables (users, orders, subscriptions, engagement).
* ``functions`` -- column helpers and shared plan shapes (floor-days, exact
                   distributed quantiles, prefix sums over sorted scores).
* ``operators`` -- cleaning, quality rules, labels, features, feature table,
                   metrics, scoring, drift, diagnostics.
* ``ml``        -- splits, scaling, Spark ML fits, tuning, calibration.
* ``plans``     -- composed jobs (feature matrix, drift report, batch scoring)
                   and the query registry used by ``__spark_entry__``.
* ``streaming`` -- Structured Streaming versions of the alerting jobs.
"""

from churnlake.params import Params

__all__ = ["Params"]
