"""demandloom: Spark jobs that turn daily retail sales into dense demand-feature tables."""
