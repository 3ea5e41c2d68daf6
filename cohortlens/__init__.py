"""cohortlens package."""
