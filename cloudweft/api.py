"""The library's public names in one place."""

from cloudweft.errors import ConfigError, InsecureDirectoryError, ScanPackageError
from cloudweft.functions.messages import Job, parse_job, validated
from cloudweft.functions.rigid import Rigid
from cloudweft.objects import Bucket, Scratch, connect
from cloudweft.operators.pose_graph import Edge, Rejected
from cloudweft.plans.merge import ExportPlan, MergeOutputs, export_merged_cloud, export_original_scans, export_transformed_scans, merge_scan_projects, placed
from cloudweft.plans.registration import RegistrationParams, RegistrationResult, register_keyframes, register_scans
from cloudweft.sinks.report import write_report
from cloudweft.sources.packages import GeoReference, ScanPackage, discover, open_package, scans
from cloudweft.sources.points import ScanPoints, read_points

__all__ = [
    "Bucket", "ConfigError", "Edge", "ExportPlan", "GeoReference", "InsecureDirectoryError", "Job", "MergeOutputs", "RegistrationParams", "RegistrationResult", "Rejected", "Rigid", "ScanPackage", "ScanPackageError",
    "ScanPoints", "Scratch", "connect", "discover", "export_merged_cloud", "export_original_scans", "export_transformed_scans", "merge_scan_projects", "open_package", "parse_job", "placed", "read_points", "register_keyframes", "register_scans", "scans", "validated", "write_report",
]
