from crashlens.streaming.incremental import run_incremental_reports

__all__ = ["run_incremental_reports"]
