"""Report scans, JSON dimension sources and the test-table adapters."""
