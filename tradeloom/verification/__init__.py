"""Every operator as a query on the star tables, with equal SQL to compare."""
