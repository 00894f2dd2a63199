"""ashgrid: geospatial daily risk analytics as Spark DataFrame operators and jobs.

Modules: ``operators`` (time series, hot-key windows, filters, geo, raster,
cache, weather, metrics, splits, models, drift), ``sources`` and ``sinks``
(file formats), ``functions`` (column expressions), ``plans`` (end-to-end
jobs), ``streaming`` (resumable runs) and ``catalog`` (one registered query
per operator, with its DuckDB oracle SQL).
"""

__version__ = "0.1.0"
