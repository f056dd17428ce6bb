"""CSV sources, tables and the star-table adapter."""
