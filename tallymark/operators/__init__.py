"""DataFrame operators for batch reconciliation; those without ordering also run on streams."""
