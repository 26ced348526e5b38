"""Names and literals inside SQL text.

Large expressions are written as SQL text: Spark parses one in a single call, where putting it together
from columns takes a call to the driver's JVM per operation.
"""

from __future__ import annotations


def quoted(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(*parts: str) -> str:
    """Column name, or path into a struct, safe for any characters."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)
