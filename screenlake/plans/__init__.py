"""Settings and adapters."""
