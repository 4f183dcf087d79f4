"""Reading landing files and writing tables, logs and views."""
