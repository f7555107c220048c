"""Scalar Column functions (survey 2.8). All are native expressions: no Python per row."""

from tessera.functions.dates import *  # noqa: F401,F403
from tessera.functions.maps import *  # noqa: F401,F403
from tessera.functions.geo import *  # noqa: F401,F403
from tessera.functions.boxes import *  # noqa: F401,F403
from tessera.functions.misc import *  # noqa: F401,F403
