"""Trip and flow analytics as lazy, composable PySpark DataFrame operators."""

from tripfold.params import SpecialZones, TripWindow

__all__ = ["SpecialZones", "TripWindow"]
