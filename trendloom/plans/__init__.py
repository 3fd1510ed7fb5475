"""The layers: Silver, enrichment, Gold, serving views, retrieval, run metrics and jobs."""
