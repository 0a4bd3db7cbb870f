"""Cleaning, loading, marts, questions, reports and the job list."""
