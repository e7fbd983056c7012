from tallyhour.sources.tables import read_table, read_inputs, empty_ssot  # noqa: F401
from tallyhour.sources.staging import (write_staging, apply_retention, expire_partitions,  # noqa: F401
                                       write_ssot_partitions)
from tallyhour.sources.fixtures import derived_inputs, DIMENSION_ROWS  # noqa: F401
