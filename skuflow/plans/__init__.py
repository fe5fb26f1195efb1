"""Plans: channel builders (C1–C18), reports (R1–R11) and the driver-table queries."""
