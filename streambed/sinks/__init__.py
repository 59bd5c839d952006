"""Writers of lake tables, files and mart exports."""
