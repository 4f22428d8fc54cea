from drawdown.functions.bands import *  # noqa: F401,F403
from drawdown.functions.exprs import *  # noqa: F401,F403
