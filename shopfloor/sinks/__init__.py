"""Writers for the extract."""
