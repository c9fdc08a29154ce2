"""All registered queries."""

from fraudlens.plans import dashboards, evaluation, layers, streams, training
from fraudlens.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "dashboards", "evaluation", "layers", "streams", "training"]
