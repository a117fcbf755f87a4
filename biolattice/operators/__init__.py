"""DataFrame-to-DataFrame operators, one module per family."""
from . import (acoustic, boosting, clean, community, coverage, distribution, genetics, grids, joins,
               models, permutation, phylogeny, pixels, trends)

__all__ = ["acoustic", "boosting", "clean", "community", "coverage", "distribution", "genetics", "grids",
           "joins", "models", "permutation", "phylogeny", "pixels", "trends"]
