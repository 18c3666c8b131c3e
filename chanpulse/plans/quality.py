"""Quality check job: fresh rows in both tables, channel checked first."""

from __future__ import annotations

from ..functions.derive import as_of_literal
from ..operators.rules import check_freshness
from ..schemas import FRESH_DAYS
from .load import Warehouse


def quality_check(wh: Warehouse, as_of=None, days: int = FRESH_DAYS,
                  video_column: str = "created_at") -> dict:
    """Raises ``ValueError`` ("No recent channel data found" / "No recent
    video data found"); returns both counts otherwise.  ``created_at`` of a
    video is kept on update, so the check fails when no *new* video arrived
    for ``days`` days (pass ``video_column="updated_at"`` to count updates).  Only the
    folders of the months since then are read."""
    return check_freshness(wh.channels.stored(), wh.videos.stored(), as_of_literal(as_of),
                           days, video_column)
