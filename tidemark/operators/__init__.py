"""DataFrame operators over a change log."""
