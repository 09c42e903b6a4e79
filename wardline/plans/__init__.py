"""Plans: the model graph, table builds, documented analyses."""

from wardline.plans.graph import ModelGraph

__all__ = ["ModelGraph"]
