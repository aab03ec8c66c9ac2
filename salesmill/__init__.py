"""Layered sales analytics on Spark: bronze files, silver enrichment and upserts, gold profit."""

from . import functions, operators, plans, schemas, sinks, sources
from .functions import *  # noqa: F403
from .operators import *  # noqa: F403
from .plans import *  # noqa: F403
from .session import LAYERS, Layers, configure, get_spark_session, scratch_folder, stage
from .sinks import *  # noqa: F403
from .sources import *  # noqa: F403

__all__ = [
    "LAYERS",
    "Layers",
    "configure",
    "get_spark_session",
    "schemas",
    "scratch_folder",
    "stage",
    *functions.__all__,
    *operators.__all__,
    *plans.__all__,
    *sinks.__all__,
    *sources.__all__,
]
