"""DataFrame -> DataFrame operators. Column names and limits are parameters."""
