"""Jobs on unbounded input."""

from haulmark.streaming.monitor import bandwidth_monitor, start_monitor

__all__ = ["bandwidth_monitor", "start_monitor"]
