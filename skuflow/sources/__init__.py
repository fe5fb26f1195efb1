"""Sources: report scans (S1–S5), file discovery (S6–S8, S10), configuration
dimensions (S9) and landed API payloads (D5–D10)."""
