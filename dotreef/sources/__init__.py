from .dimensions import literal_table, read_classification, read_crosswalk, starter_classification
from .metadata import read_metadata, synthesise_metadata
from .ragged import read_annotations, scan_ragged
from .sinks import read_plain_csv, scratch_dir, store_points, write_metadata, write_report, write_upload, write_upload_files

__all__ = [
    "literal_table",
    "read_annotations",
    "read_classification",
    "read_crosswalk",
    "read_metadata",
    "read_plain_csv",
    "scan_ragged",
    "scratch_dir",
    "starter_classification",
    "store_points",
    "synthesise_metadata",
    "write_metadata",
    "write_report",
    "write_upload",
    "write_upload_files",
]
