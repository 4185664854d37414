"""DataFrame -> DataFrame operators, column names as parameters."""
