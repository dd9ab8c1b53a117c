"""Column -> Column building blocks (all JVM-side, codegen friendly)."""

from .calendar import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
from .classify import classify  # noqa: F401
