from tallyhour.functions.exprs import *  # noqa: F401,F403
from tallyhour.functions.exprs import __all__  # noqa: F401
