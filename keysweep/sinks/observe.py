"""Reading ``Observation`` metrics after an action."""

from __future__ import annotations

from pyspark.sql import Observation


def observed(obs: Observation, **defaults: int) -> dict:
    """The observed metrics, with ``defaults`` for any that are missing.

    When the observed plan ran no task at all (an input with no partitions,
    such as a key file holding only its header), Spark records no metrics
    row and ``Observation.get`` fails; that means every count is zero.
    """
    try:
        row = obs.get
    except Exception:  # no metrics row: nothing was processed
        return dict(defaults)
    return {k: (row[k] if k in row and row[k] is not None else v) for k, v in defaults.items()}
