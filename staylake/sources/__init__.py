"""Feed schemas, loaders, sinks and the test-table fixture."""
