"""Writers of tables, results and plans."""
