"""skuflow — multichannel sales & inventory reporting as Spark DataFrame plans.

Every public function takes and returns lazy DataFrames (or small dataclasses of
DataFrames). Nothing here collects fact data to the driver; the only actions are
the explicit quality gate, size probes of configuration dimensions, and sinks.
"""

from skuflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
