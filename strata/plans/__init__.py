"""End-to-end plans: driver-table fixtures, the medallion run, and the query registry."""
