"""All layers in order."""

from __future__ import annotations

from datetime import datetime

from strata.plans.gold import load_calendar, load_dimension, load_fact
from strata.plans.ingest import Reader, ingest_all
from strata.plans.layers import LoadResult, Layers, side_by_side
from strata.plans.silver import load_silver
from strata.schemas import DIMENSIONS, SOURCES


def run_silver(layers: Layers, now: datetime) -> list[LoadResult]:
    """The six cleaned tables."""
    return side_by_side(lambda source: load_silver(layers, source.object, now), SOURCES)


def run_gold(layers: Layers, now: datetime, *, fact_mode: str = "either") -> list[LoadResult]:
    """Calendar, dimensions, then the fact table that refers to them."""
    return [
        load_calendar(layers),
        *side_by_side(lambda dim: load_dimension(layers, dim, now), DIMENSIONS),
        load_fact(layers, now, mode=fact_mode),
    ]


def run_all(layers: Layers, reader: Reader, now: datetime, *, fact_mode: str = "either") -> list[LoadResult]:
    """Ingest, clean, load dimensions and facts. A failing step stops the run."""
    return [*ingest_all(layers, reader, now), *run_silver(layers, now), *run_gold(layers, now, fact_mode=fact_mode)]
