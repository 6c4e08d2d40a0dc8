"""The reference-shaped tables derived from the test data, queries over them, oracles."""
