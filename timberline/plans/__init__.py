"""User-level jobs and queries, composed of the operators."""
