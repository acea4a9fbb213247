"""Part of the curation package."""
