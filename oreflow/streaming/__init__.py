from oreflow.streaming.flows import (
    SilverBatches,
    append_stream,
    apply_changes_stream,
    batch_stream,
    bronze_stream,
    silver_stream,
)

__all__ = [
    "SilverBatches", "append_stream", "apply_changes_stream", "batch_stream", "bronze_stream", "silver_stream",
]
