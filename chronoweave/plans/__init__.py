"""Whole jobs composed from sources and operators."""

from chronoweave.plans.dataset_import import build_dataset, import_dataset
from chronoweave.plans.rdbms_import import rdbms_import

__all__ = ["build_dataset", "import_dataset", "rdbms_import"]
