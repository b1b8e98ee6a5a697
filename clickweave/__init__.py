"""Click-prediction features and evaluation as Spark DataFrame operators.

Every public operator takes DataFrames and returns DataFrames.  The canonical
shapes are

* lines         ``obs_id BIGINT, line STRING``
* observations  ``obs_id BIGINT, label DOUBLE, feats ARRAY<STRING>``
* features      ``obs_id BIGINT, label DOUBLE, feature_id INT, value STRING``
* dictionary    ``feature_id INT, value STRING, idx BIGINT, n BIGINT``
* encoded       ``obs_id BIGINT, label DOUBLE, indices ARRAY<BIGINT>, values ARRAY<DOUBLE>``
* scored        ``obs_id BIGINT, label DOUBLE, p DOUBLE``

Extra columns such as ``split`` ride along unchanged.
"""
