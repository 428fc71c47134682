"""DataFrame -> DataFrame operators: gate, staging, enrichment, marts, analysis, expectations."""
