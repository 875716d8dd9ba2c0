"""Sources: topics, configuration and dimension tables, shop tables."""
