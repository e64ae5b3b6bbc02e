"""Market time series on Spark: ticks, composites, bars, volatility, Renko bricks, calibration and data-quality checks."""

__version__ = "0.1.0"
