"""Whole runs: readings in, aligned tables out."""

from tsnorm.plans.normalize import Aligned, Report, normalize, normalize_files

__all__ = ["Aligned", "Report", "normalize", "normalize_files"]
