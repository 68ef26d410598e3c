"""All registered queries of this package."""

from stationlake.llm import queries_native, queries_python, queries_repair  # noqa: F401
from stationlake.llm.registry import ORACLES, QUERIES  # noqa: F401
