"""Table-level building blocks: deduplication, ledgers, snapshots, quality rules, suppression."""
