"""Sinks: curated tables in the catalog, written positionally."""
