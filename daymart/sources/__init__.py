"""Scans: typed/lenient CSV under a contract, Parquet, file inventories, manifests."""

from daymart.sources.scan import (  # noqa: F401
    read_dataset, read_raw, read_typed, project_required, header_violations,
    strict_cast_violations, with_position,
)
from daymart.sources.files import (  # noqa: F401
    file_inventory, build_manifest, read_manifest, manifest_violations,
    file_integrity_violations,
)
