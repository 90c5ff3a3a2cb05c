"""Structured Streaming jobs: the log stream and the rule sync."""

from .job import (LogJob, Outputs, ProgressLog, RuleCache, compact, output_counts, read_log_stream, read_output,
                  read_progress)

__all__ = ["LogJob", "Outputs", "ProgressLog", "RuleCache", "compact", "output_counts", "read_log_stream", "read_output",
           "read_progress"]
