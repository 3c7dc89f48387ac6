"""The batch job, SQL over views, and the checked queries on the shared test tables."""
