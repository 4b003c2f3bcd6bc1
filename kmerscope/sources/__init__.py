"""Readers and writers: Parquet sequence tables, FASTA, dataset folders, run logs."""
