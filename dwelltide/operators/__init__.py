"""DataFrame operators; those that need no state work on tables and on streams."""
