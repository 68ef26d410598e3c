"""Reading the bulk files and the catalogue, and keeping the typed tables."""
