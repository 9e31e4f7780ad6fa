from .readers import *  # noqa: F401,F403
from .sinks import *  # noqa: F401,F403
