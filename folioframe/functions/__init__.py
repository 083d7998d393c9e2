"""Column-to-Column functions; none of them shuffles."""
