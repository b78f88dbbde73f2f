"""Output projections and the end-to-end job."""
