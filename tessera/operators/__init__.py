"""DataFrame -> DataFrame operators (survey section 2)."""
