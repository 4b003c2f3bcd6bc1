"""Composite jobs: the end-to-end comparisons, sampling and run-log reports."""
