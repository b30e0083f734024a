"""Models trained on the cluster: gradient descent over packed blocks, and Spark ML classifiers."""

from levyflow.models.bagged_forest import BaggedForest, fit_bagged_forest
from levyflow.models.blocks import Blocks, pack_blocks
from levyflow.models.classifiers import fit_forest, fit_perceptron
from levyflow.models.descent import Fit, Task, descend
from levyflow.models.mlp import MlpLoss
from levyflow.models.perceptron import fit_packed_perceptron
from levyflow.models.svr import SvrLoss

__all__ = [
    "BaggedForest",
    "Blocks",
    "Fit",
    "MlpLoss",
    "SvrLoss",
    "Task",
    "descend",
    "fit_bagged_forest",
    "fit_forest",
    "fit_packed_perceptron",
    "fit_perceptron",
    "pack_blocks",
]
