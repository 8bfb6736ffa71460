"""starhouse: a layered star-schema warehouse expressed as Spark DataFrame jobs."""

from starhouse.profile import HEALTH, RETAIL, Profile
from starhouse.session import build_session

__all__ = ["HEALTH", "RETAIL", "Profile", "build_session"]
