from loadlens.functions.measures import *  # noqa: F401,F403
from loadlens.functions.text import *  # noqa: F401,F403
