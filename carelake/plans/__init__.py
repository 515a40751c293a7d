"""Silver builders, gold datamarts, reports and the chain of layers."""
