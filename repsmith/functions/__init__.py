"""``Column -> Column`` building blocks (scalars and JSON)."""

from repsmith.functions.scalars import *  # noqa: F401,F403
from repsmith.functions.json import *  # noqa: F401,F403
