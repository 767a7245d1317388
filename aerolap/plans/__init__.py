"""Query registry, oracle SQL and plan inspection."""
