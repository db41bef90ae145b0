"""End-to-end jobs: read, transform, write."""
