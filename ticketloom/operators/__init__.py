"""DataFrame -> DataFrame operators; all lazy, none collects."""
