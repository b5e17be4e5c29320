"""Table builders: staging, dimensions, fact, reports, marts, search, enrichment, catalog."""
