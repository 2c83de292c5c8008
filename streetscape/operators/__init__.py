"""DataFrame -> DataFrame operators. Each one builds a lazy plan; none collects data rows."""
