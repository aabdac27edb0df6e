"""Algorithms and the ranges their parameters are drawn from."""

from __future__ import annotations

import random

# Algorithm labels, and search ranges as (kind, *limits).
NAMES = {
    "NB": "Naive Bayes", "LR": "Logistic Regression", "DT": "Decision Tree", "RF": "Random Forest",
    "GB": "Gradient Boosting", "SVM": "Support Vector Machine", "ANN": "Artificial Neural Network",
    "KN": "K Nearest Neighbors",
}
WEIGHTS = ("choice", None, "balanced")
SPACES: dict[str, dict[str, tuple]] = {
    "NB": {},
    "LR": {
        "C": ("log", 1e-5, 1e5), "penalty": ("choice", "l2", "l1"), "class_weight": WEIGHTS,
        "max_iter": ("log_int", 10, 1000),
    },
    "DT": {
        "impurity": ("choice", "gini", "entropy"), "max_depth": ("int", 1, 30), "min_leaf": ("int", 1, 50),
        "class_weight": WEIGHTS,
    },
    "RF": {
        "n_trees": ("int", 10, 1000), "impurity": ("choice", "gini", "entropy"), "max_depth": ("int", 1, 30),
        "min_leaf": ("int", 1, 50), "feature_subset": ("choice", "all", "sqrt", "log2"), "class_weight": WEIGHTS,
    },
    "GB": {
        "rounds": ("int", 10, 1000), "rate": ("log", 1e-4, 0.3), "max_depth": ("int", 1, 30), "min_leaf": ("int", 1, 50),
        "row_fraction": ("uniform", 0.5, 1.0), "column_fraction": ("uniform", 0.1, 1.0),
        "min_gain": ("log", 1e-8, 1.0), "class_weight": WEIGHTS,
    },
    "SVM": {
        "C": ("log", 0.1, 1000.0), "kernel": ("choice", "linear", "poly", "rbf"), "degree": ("int", 1, 6),
        "class_weight": WEIGHTS,
    },
    "ANN": {
        "n_layers": ("int", 1, 3), "layer_size": ("int", 1, 100), "solver": ("choice", "gd", "l-bfgs"),
        "max_iter": ("choice", 200),
    },
    "KN": {"k": ("int", 1, 100), "weights": ("choice", "uniform", "distance"), "p": ("int", 1, 5)},
}


def is_single(space: dict[str, tuple]) -> bool:
    """Nothing to search: every parameter has one value."""
    return all(kind == "choice" and len(limits) == 1 for kind, *limits in space.values())


def draw(space: dict[str, tuple], rng: random.Random) -> dict:
    out = {}
    for name, (kind, *limits) in space.items():
        if kind == "choice":
            out[name] = rng.choice(limits)
        elif kind == "int":
            out[name] = rng.randint(*limits)
        elif kind == "uniform":
            out[name] = rng.uniform(*limits)
        else:
            low, high = limits
            value = low * (high / low) ** rng.random()
            out[name] = int(round(value)) if kind == "log_int" else value
    return out
