"""Imports every query module so the registry is complete."""

from . import features, training, ranking, evaluation, storage, monitoring, declared, live, models  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
