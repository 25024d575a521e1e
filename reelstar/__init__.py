"""reelstar: video-engagement star schema on Spark.

Raw view events and media snapshots (JSON Lines, partitioned by
``ingest_date``) become three dimensions and two date-partitioned facts.
Every transformation is a DataFrame plan; Catalyst and AQE pick the
physical strategy.
"""

__version__ = "0.1.0"
