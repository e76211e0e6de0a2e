from ferry.sinks.publish import (
    append_crosswalk,
    publish_snapshot,
    read_crosswalk,
    read_crosswalk_runs,
    read_outcomes,
    read_run,
    run_ids,
    write_csv,
    write_outcomes,
)

__all__ = ["append_crosswalk", "publish_snapshot", "read_crosswalk", "read_crosswalk_runs",
           "read_outcomes", "read_run", "run_ids",
           "write_csv", "write_outcomes"]
