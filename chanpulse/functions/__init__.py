"""Column-level functions."""
from .derive import *  # noqa: F401,F403
from .text import fixed4, short_title, stamp_text, thousands  # noqa: F401
