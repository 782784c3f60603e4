"""Reading, landing, profiling and refreshing tables."""
