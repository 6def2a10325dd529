"""Data-quality profiling and assessment as Spark jobs."""

from .functions.times import dated_names
from .plans.assess import AssessmentResult, Reference, assess, assess_frame, rescore_rows
from .plans.profile import batch_metrics, extend_rows, profile_batch, profile_files
from .operators.accuracy import Expected
from .operators.consistency import Rule
from .operators.inference import ColumnTypes, infer_types
from .operators.selection import Range
from .operators.timeliness import Validity
from .sources.readers import TextLayout
from .sources.state import SourceState
from .spec import AssessmentSpec, ProfileSpec

__all__ = [
    "AssessmentResult", "AssessmentSpec", "ColumnTypes", "Expected", "ProfileSpec", "Range", "Reference", "Rule",
    "SourceState", "TextLayout", "Validity", "assess", "assess_frame", "batch_metrics", "dated_names",
    "extend_rows", "infer_types", "profile_batch", "profile_files", "rescore_rows",
]
