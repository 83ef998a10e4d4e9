"""Files, landing, inventories and tables with a commit log."""
