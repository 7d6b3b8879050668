"""Column -> Column helpers: rounding, date parts, business labels and scores."""

from .exprs import *  # noqa: F401,F403
from .labels import *  # noqa: F401,F403
