"""Writers: one JSON key and value per line."""
