"""End-to-end plans (features → PIT → score → evaluate) and the registered queries."""
