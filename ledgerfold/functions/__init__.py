"""Column-to-column functions. All are built-in expressions; none is a UDF."""

from . import dates as _dates
from . import money as _money
from . import text as _text
from .dates import *      # noqa: F401,F403
from .money import *      # noqa: F401,F403
from .text import *       # noqa: F401,F403

__all__ = [*_dates.__all__, *_money.__all__, *_text.__all__]
