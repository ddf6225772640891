from .findings import FindingsLog, open_findings, watch
from .landing import Landing, annotations, deployments, refresh_counts
from .levels import Levels

__all__ = ["FindingsLog", "Landing", "Levels", "annotations", "deployments", "open_findings", "refresh_counts", "watch"]
