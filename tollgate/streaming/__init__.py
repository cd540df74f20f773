from .quarantine import drift_path, quarantine_stream, rejected_rows

__all__ = ["drift_path", "quarantine_stream", "rejected_rows"]
