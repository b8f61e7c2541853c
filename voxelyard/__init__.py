"""voxelyard: a PySpark-native analytics engine for spatial captures."""

__version__ = "0.1.0"
