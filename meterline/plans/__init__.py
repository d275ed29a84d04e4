"""Plans: driver-table adapters, end-to-end jobs, the query registry and its SQL oracle."""
