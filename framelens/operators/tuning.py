"""Hyperparameters of the next trial from those before."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

import numpy as np

Space = Mapping[str, Sequence[float]]  # name: low, high and, if given, a gain that scales its steps


def constrained(values: Mapping[str, float], space: Space, whole: Collection[str] = ()) -> dict[str, float]:
    """Values within their bounds: whole numbers where asked for, else five places."""
    out = {}
    for name, (low, high, *_) in space.items():
        if name in whole:
            low, high = int(np.ceil(low)), int(np.floor(high))
            if low > high:
                raise ValueError(f"{name} has no whole number between its bounds")
        out[name] = min(max(round(values[name]) if name in whole else round(float(values[name]), 5), low), high)
    return out


def mutate(history: Sequence[tuple[float, Mapping[str, float]]], space: Space, defaults: Mapping[str, float], rng: np.random.Generator, whole: Collection[str] = (), parents: int = 9, sigma: float = 0.2, tries: int = 200) -> dict[str, float]:
    """Hyperparameters that no trial (fitness, hyperparameters) has had; the defaults where there is none.

    A parent is drawn from the best, the fitter the likelier, and about half of its values take a normal step over their
    range, which shrinks by up to a fifth over 25 trials without progress. The second half of the tries draws anew.
    """
    if not history:
        return constrained(defaults, space, whole)
    free = [k for k, (low, high, *_) in space.items() if high > low]
    if not free:
        raise ValueError("no hyperparameter is left to change")
    order = sorted(range(len(history)), key=lambda i: -history[i][0])
    best = [history[i] for i in order[:parents]]
    weights = np.array([f for f, _ in best]) - min(f for f, _ in best) + 1e-6
    weights = weights / weights.sum() if np.isfinite(weights).all() else np.full(len(best), 1 / len(best))
    step = sigma * (1 - 0.2 * min((len(history) - 1 - int(np.argmax([round(f, 5) for f, _ in history]))) / 25, 1))
    seen = {tuple(constrained(h, space, whole).values()) for _, h in history}
    for attempt in range(tries):
        child = dict(best[rng.choice(len(best), p=weights)][1])
        for k in free:
            low, high, *gain = space[k]
            if attempt >= tries // 2:
                child[k] = rng.uniform(low, high)
            elif rng.random() < 0.5:
                least = (1.0 if k in whole else 1e-5) / (high - low)
                child[k] += rng.standard_normal() * max(step * (gain[0] if gain else 1.0), least) * (high - low)
        child = constrained(child, space, whole)
        if tuple(child.values()) not in seen:
            return child
    raise RuntimeError("no new combination was found")
