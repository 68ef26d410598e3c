"""Weather condition codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the condition codes 1 to 27.
CONDITIONS = (
    "Clear",
    "Fair",
    "Cloudy",
    "Overcast",
    "Fog",
    "FreezingFog",
    "LightRain",
    "Rain",
    "HeavyRain",
    "FreezingRain",
    "HeavyFreezingRain",
    "Sleet",
    "HeavySleet",
    "LightSnowfall",
    "Snowfall",
    "HeavySnowfall",
    "RainShower",
    "HeavyRainShower",
    "SleetShower",
    "HeavySleetShower",
    "SnowShower",
    "HeavySnowShower",
    "Lightning",
    "Hail",
    "Thunderstorm",
    "HeavyThunderstorm",
    "Storm",
)


def condition_name(code: Column) -> Column:
    """Name of a condition code; null for an unknown code."""
    pairs = ((F.lit(n).cast("bigint"), F.lit(name)) for n, name in enumerate(CONDITIONS, 1))
    return F.element_at(F.create_map(*chain.from_iterable(pairs)), code.cast("bigint"))
