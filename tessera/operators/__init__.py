"""DataFrame -> DataFrame operators: filters, model, quality, marts, statistics."""

from . import filters, marts, model, quality, quantiles, ranking, staging, stats

__all__ = ["filters", "marts", "model", "quality", "quantiles", "ranking", "staging", "stats"]
