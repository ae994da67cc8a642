"""Training-data pipeline operators: mixing, sharding, decontamination, scoring, joins, search and filters."""
