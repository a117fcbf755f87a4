"""Live forms of the detection operators."""
from .detections import detection_sessions, hourly_contacts, read_detections, tidy_live

__all__ = ["detection_sessions", "hourly_contacts", "read_detections", "tidy_live"]
