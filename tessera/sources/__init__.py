"""Readers, writers (survey 2.1) and the stand-ins built from the driver's tables."""

from tessera.sources import standins  # noqa: F401
from tessera.sources.files import *  # noqa: F401,F403
