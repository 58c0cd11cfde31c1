"""DataFrame -> DataFrame operators, meant for ``df.transform(...)``. All are lazy."""
