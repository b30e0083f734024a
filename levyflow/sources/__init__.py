"""Readers and writers. Paths are plain Hadoop URIs, so any scheme the cluster knows works."""

from levyflow.sources.readers import read_delimited, read_rejects, read_table
from levyflow.sources.scratch import scratch_path
from levyflow.sources.writers import write_delimited, write_loss_curve, write_metrics, write_single_file, write_table

__all__ = [
    "read_delimited",
    "read_rejects",
    "read_table",
    "scratch_path",
    "write_delimited",
    "write_loss_curve",
    "write_metrics",
    "write_single_file",
    "write_table",
]
