"""tallyspark: change feeds to machine-learning features on Spark.

Main entry points
-----------------
* ``operators.changes``: ``parse_changes``, ``current_rows``, ``ingest_day``
* ``operators.features``: ``window_features``, ``backfill_features``,
  ``calendar_features``, ``keep_last``
* ``operators.store``: ``FeatureView``, ``get_historical_features`` (as-of
  join), ``materialize``, ``get_online_features``
* ``operators.quality``: ``require_dates``, ``compare_features``
* ``streaming.streams``: ``stream_window_features``, ``start_current_state``
* ``jobs`` / ``python -m tallyspark``: the daily jobs
* ``session``: ``get_session``, ``cluster_settings``, ``checkpoint_root``
"""
