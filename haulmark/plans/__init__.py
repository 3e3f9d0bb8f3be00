"""Whole jobs: compare two trees, copy a tree or a manifest, plan and run a sync, clean up."""

from haulmark.plans.cleanup import cleanup_dir, cleanup_uploads
from haulmark.plans.compare import compare_file, compare_pairs, compare_trees
from haulmark.plans.copying import copy_manifest, copy_pairs, copy_tree
from haulmark.plans.sync import SyncPlan, SyncResult, keep_attributes, plan_sync, run_sync
from haulmark.plans.waves import Journal, copy_in_waves

__all__ = [
    "Journal", "SyncPlan", "SyncResult", "cleanup_dir", "cleanup_uploads", "compare_file", "compare_pairs", "compare_trees",
    "copy_in_waves", "copy_manifest", "copy_pairs", "copy_tree", "keep_attributes", "plan_sync", "run_sync",
]
