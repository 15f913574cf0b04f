"""Sources: fixture views, JSON event feeds, JDBC tables."""
