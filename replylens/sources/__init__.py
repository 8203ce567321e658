"""Sources: CSV scans of user files and adapters over the provided test tables."""
