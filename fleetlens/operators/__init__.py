"""DataFrame -> DataFrame operators; every one runs distributed and never collects data."""
