"""Sources: raw and batch CSV files (read, write, list) and the model registry."""
