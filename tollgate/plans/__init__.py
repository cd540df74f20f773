from .run import RunResult, run_quality

__all__ = ["RunResult", "run_quality"]
