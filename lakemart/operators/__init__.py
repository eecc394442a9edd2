"""DataFrame-to-DataFrame operators of the lakehouse."""
