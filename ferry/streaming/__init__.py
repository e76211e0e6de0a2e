from ferry.streaming.crosswalk import outcome_schema, start_crosswalk_stream
from ferry.streaming.outcomes import start_outcome_totals_stream

__all__ = ["outcome_schema", "start_crosswalk_stream", "start_outcome_totals_stream"]
