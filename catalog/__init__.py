"""The queries this repository registers, and the SQL each of them is checked against."""
