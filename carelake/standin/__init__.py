"""Check harness: the driver's tables in the shape of the bronze tables, with oracle SQL."""
