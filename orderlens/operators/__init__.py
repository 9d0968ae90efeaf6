"""Table-in / table-out operators (every function returns a lazy DataFrame)."""
