"""chronoweave: build analysis-ready time-series datasets on Spark.

Sources (CSV tag files, Parquet tables, JDBC databases) are read as DataFrames, turned into
epoch-second series, resampled to a common interval, aligned on one timeline, validated and
stored as a packed table with a schema catalog.  Every step is a DataFrame -> DataFrame
function, so one Catalyst plan covers a whole import.
"""

from chronoweave.operators.align import align, align_by_joins, time_grid, time_grid_from_bounds, union_keys
from chronoweave.operators.gaps import infer_interval, next_gap
from chronoweave.operators.pack import pack, pack_rdbms, unpack
from chronoweave.operators.quality import rejects_report, type_error_counts, validate
from chronoweave.operators.resample import downsample, resample, resample_plan, upsample
from chronoweave.plans.dataset_import import build_dataset, build_from_long, import_dataset
from chronoweave.plans.rdbms_import import rdbms_import
from chronoweave.sources.registry import read_source
from chronoweave.sources.store import DatasetStore
from chronoweave.specs import ImportRule, SourceSpec, TagSpec, sources_from_json_fields

__all__ = [
    "DatasetStore", "ImportRule", "SourceSpec", "TagSpec", "align", "align_by_joins", "build_dataset",
    "build_from_long", "downsample", "import_dataset", "infer_interval", "next_gap", "pack", "pack_rdbms",
    "rdbms_import", "read_source", "rejects_report", "resample", "resample_plan", "sources_from_json_fields",
    "time_grid", "time_grid_from_bounds", "type_error_counts", "union_keys", "unpack", "upsample", "validate",
]
