"""DataFrame operators; each is a lazy DataFrame -> DataFrame function."""
