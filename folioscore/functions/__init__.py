from .scalar import *  # noqa: F401,F403
from .arrays import *  # noqa: F401,F403
