"""Readers: landing-folder listing, Parquet scans, conformed unions of drifting files."""
