"""Writers of gold tables and their catalog entries."""
