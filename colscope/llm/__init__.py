"""Training-data operators: ten corpus operators that share nothing with the profiler."""
