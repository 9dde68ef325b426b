"""Layer jobs: bronze ingest, silver cleaning, gold comparison, profiling, ordered run."""
