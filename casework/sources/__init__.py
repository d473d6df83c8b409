"""Table schemas, readers, sinks and run-scoped staging."""
