"""Query plans: fixtures, the registered query catalog and composite jobs."""
