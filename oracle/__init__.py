"""Independent SQL statements for checking results in another engine."""
