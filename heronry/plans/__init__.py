"""Plans."""
