"""The medallion layers, composed from operators and functions."""
