"""starmart — a star-schema warehouse for file-based fine records, on Spark.

Layers (all lazy DataFrame plans; nothing passes through the driver):

* ``sources``   — multi-file delimited ingest, parquet/table scans, sinks.
* ``functions`` — native ``Column`` expressions: cleaning rules, parsers,
  calendar, exact rounding, labels.
* ``operators`` — generic table operators: dense surrogate keys, key
  attachment, data-quality checks, profiling, report metrics.
* ``plans``     — composite flows: the two normalisation presets, the star
  build and the reports.
"""

__version__ = "0.1.0"

from starmart.plans.prepare import normalize  # noqa: E402
from starmart.plans.reports import REPORTS  # noqa: E402
from starmart.plans.star import Star, build_star, register_views, star_from_tables, write_star  # noqa: E402
from starmart.plans.warehouse import load_warehouse, write_reports  # noqa: E402
from starmart.session import RECOMMENDED_CONF  # noqa: E402
from starmart.sources.csv import read_raw, sniff_files  # noqa: E402

__all__ = [
    "RECOMMENDED_CONF",
    "REPORTS",
    "Star",
    "build_star",
    "load_warehouse",
    "normalize",
    "read_raw",
    "register_views",
    "sniff_files",
    "star_from_tables",
    "write_reports",
    "write_star",
]
