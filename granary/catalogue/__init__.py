"""The query catalogue: every job and operator on a common set of test tables."""
