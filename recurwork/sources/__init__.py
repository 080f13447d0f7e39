"""Sources and sinks: table scans, the test-fixture views, result files."""
