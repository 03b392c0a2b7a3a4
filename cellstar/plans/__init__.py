"""Questions answered over the star schema and the metadata tables."""
