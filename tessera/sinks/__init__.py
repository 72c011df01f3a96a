"""Writers (K*): run-dated Parquet, CSV, keyed datasets, typed loads,
staged single files, dashboards, archives, JSON records, feature snapshots."""

from tessera.sinks.maintained import *  # noqa: F401,F403
from tessera.sinks.writers import *  # noqa: F401,F403
