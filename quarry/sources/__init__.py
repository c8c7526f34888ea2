"""Sources: projected CSV extract with NA decoding (S1-S4), table scans and
driver-table views (S5, S8), inline seed rows and generated frames (S6, S7)."""
