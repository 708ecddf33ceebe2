"""The registered queries again as plain SQL, for an independent engine over the same tables."""
