"""Writing: full refresh, partition-wise upserts, BI export."""
