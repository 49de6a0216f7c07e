"""keysweep: key-based purge of rows from partitioned Spark catalog tables.

Erasure requests, corrections and retention clean-ups: given keys for a table
(or a manifest covering several), find the matching rows, report the effect
per partition, back the rows up, rewrite only the partitions they touch,
publish through the catalog, audit, and restore on demand -- all as Spark
DataFrame jobs.
"""

from keysweep.plans.manifest import purge_manifest  # noqa: F401
from keysweep.plans.purge import KeySet, PurgeError, PurgeResult, dry_run, purge_table  # noqa: F401
from keysweep.plans.repair import repair_publish  # noqa: F401
from keysweep.plans.restore import restore_backup  # noqa: F401
from keysweep.session import local_session, work_root  # noqa: F401
from keysweep.streaming import purge_requests_stream  # noqa: F401,E402
