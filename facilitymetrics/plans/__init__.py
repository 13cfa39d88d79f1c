"""End-to-end datasets: curation jobs and report tables."""
