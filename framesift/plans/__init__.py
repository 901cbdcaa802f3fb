"""Multi-stage jobs composed from operators."""
