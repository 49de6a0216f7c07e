"""Pure DataFrame -> DataFrame operators: matching, survivors, effect counts."""

from keysweep.operators.effect import (  # noqa: F401
    count_keys,
    emptied_partitions,
    group_manifest,
    impacted_partitions,
    purge_effect,
    surviving_partitions,
)
from keysweep.operators.match import (  # noqa: F401
    KeySpec,
    estimate_bytes,
    flag_matches,
    keys_fit_broadcast,
    keys_found,
    keys_not_found,
    match_keys,
    match_rows,
    rows_in_partitions,
    survivors,
    survivors_in_partitions,
)
