"""Whole programs: an import with phases, a regional export and its installation, and the checks of a database."""
