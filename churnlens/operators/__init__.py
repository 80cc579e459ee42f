"""Profiling, cleaning, customer features and churn reports as DataFrame -> DataFrame jobs."""
