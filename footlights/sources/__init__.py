"""Reading and writing tables, reports and event feeds."""
