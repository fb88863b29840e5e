"""All queries of the library's own operators, and their SQL."""

from kinetrace.plans import file_queries, geometry_queries, line_queries, pixel_queries, region_queries, session_queries, track_queries, video_queries  # noqa: F401
from kinetrace.plans import split_queries, stream_queries  # noqa: F401  after the queries whose SQL they share
from kinetrace.plans.base import ORACLES, QUERIES  # noqa: F401
