"""Plans: the warehouse (load once, query many times) and the queries."""
