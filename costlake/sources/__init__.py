"""Reading charge lines, usage records and file inventories."""
