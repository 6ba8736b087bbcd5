"""Composite jobs built from the operators."""

from .cleaning_job import CleanSpec, clean
from .exploration import explore
from .produce import observations, produce

__all__ = ["CleanSpec", "clean", "explore", "observations", "produce"]
