"""Reading the JSON ``details`` text of a pipeline event log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The paths and field names an event log writes.
UPDATE_ID_PATH = "$.create_update.update_id"
EXPECTATIONS_PATH = "$.flow_progress.data_quality.expectations"
EXPECTATIONS_TYPE = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"


def update_id(details: Column | str) -> Column:
    return F.get_json_object(details, UPDATE_ID_PATH)


def expectations(details: Column | str) -> Column:
    """The expectation array of a progress event; NULL when absent or malformed. One parse, of the path's fields only."""
    fields = EXPECTATIONS_PATH.removeprefix("$.").split(".")
    kind = EXPECTATIONS_TYPE
    for name in reversed(fields):
        kind = f"struct<{name}:{kind}>"
    found = F.from_json(details, kind)
    for name in fields:
        found = found[name]
    return found
