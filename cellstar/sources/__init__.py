"""Where grids, files and tables come from and where they go."""
