"""Multi-step jobs and reports built from the operators."""
