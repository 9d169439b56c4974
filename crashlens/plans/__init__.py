from crashlens.plans.report import Reports, build_reports

__all__ = ["Reports", "build_reports"]
