"""Medallion data operators on Spark DataFrames."""

from orebelt.functions import *  # noqa: F401,F403
from orebelt.operators import *  # noqa: F401,F403
from orebelt.sinks import *  # noqa: F401,F403
from orebelt.sources import *  # noqa: F401,F403
from orebelt.streaming import *  # noqa: F401,F403
