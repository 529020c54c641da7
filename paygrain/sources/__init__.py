"""Reading: contracts, incremental loads into bronze, staging."""
