"""Sources, sinks and control tables."""
