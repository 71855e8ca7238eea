"""Feed readers and the table store."""
