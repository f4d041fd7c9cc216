"""sitewatch: site-monitoring analytics on PySpark.

Sensor reports from monitored sites are parsed (bad ones set aside), matched
against each site's threshold rules (status + alarms), averaged in event-time
windows, rolled up tier by tier with keyed upserts, ranked in sliding windows,
archived by day, and enriched with calendar columns.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function that runs unchanged on batch DataFrames and on Structured Streaming
DataFrames; only ``sources``, ``sinks`` and ``streaming`` know about I/O.
"""

from sitewatch.session import configure_session, get_spark, checkpoint_root

__all__ = ["configure_session", "get_spark", "checkpoint_root"]
