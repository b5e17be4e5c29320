"""channelwise: channel-message analytics as Spark DataFrame plans.

Layers: ``sources`` (schemas, landing scans, sinks, test-table mapping), ``functions``
(column expressions), ``operators`` (dedupe, distributed ranking, quality checks,
validation, detection job), ``plans`` (staging, dimensions, fact, reports, marts,
search, enrichment, catalog) and ``streaming`` (incremental jobs).
"""

__version__ = "0.1.0"
