"""End-to-end plans: roster load, consolidation, monitoring, regulator report."""
