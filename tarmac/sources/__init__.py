"""Reading raw datasets, staging intermediate tables, writing and serving the curated layer."""
