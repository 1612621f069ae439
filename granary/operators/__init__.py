"""DataFrame operators of the lakehouse."""
