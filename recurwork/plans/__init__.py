"""End-to-end plans: the warehouse reports (§2.10) and the interactive views (§2.11)."""
