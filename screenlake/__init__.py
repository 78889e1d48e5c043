"""Analytics of DNA-encoded library screens on Spark."""
