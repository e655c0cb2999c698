"""Jobs: compositions of operators that read and write the layers."""

from strata.plans.gold import infer_ahead, load_calendar, load_dimension, load_fact, load_inferred
from strata.plans.ingest import ingest_all, ingest_object
from strata.plans.layers import LoadResult, Layers
from strata.plans.pipeline import run_all, run_gold, run_silver
from strata.plans.silver import load_silver, stream_silver

__all__ = [name for name in dir() if not name.startswith("_")]
