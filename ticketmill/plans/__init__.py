"""Layer builds: bronze, silver, facts, dimensions, marts and dashboards."""
