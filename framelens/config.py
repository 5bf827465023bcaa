"""Layered settings: defaults, a mapping, and key=value words, checked against the defaults' names and types."""

from __future__ import annotations

from ast import literal_eval
from collections.abc import Iterable, Mapping
from difflib import get_close_matches
from typing import Any


def typed(text: str) -> Any:
    """A word as None, a boolean, a number or another literal if it is one, else as it is."""
    low = text.strip().lower()
    if low in ("none", "null", ""):
        return None
    if low in ("true", "false"):
        return low == "true"
    try:
        return literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def joined_words(words: Iterable[str]) -> list[str]:
    """Joins 'k', '=', 'v' and 'k=', 'v' and 'k', '=v' to 'k=v'; brackets that words split are put together."""
    text, out = list(words), []
    while text:
        word = text.pop(0)
        if text and (word.endswith("=") or text[0].startswith("=")):
            word += text.pop(0)
            if word.endswith("=") and text:
                word += text.pop(0)
        while text and word.count("[") > word.count("]"):
            word += text.pop(0)
        out.append(word)
    return out


def known(defaults: Mapping[str, Any], given: Mapping[str, Any]) -> None:
    """Raises for names that the defaults don't have, with those that come near."""
    for name in given:
        if name not in defaults:
            near = get_close_matches(name, defaults, n=3)
            raise KeyError(f"{name} is no setting" + (f"; did you mean {', '.join(near)}?" if near else ""))


def merged(defaults: Mapping[str, Any], *layers: Mapping[str, Any], bounds: Mapping[str, tuple[float, float]] | None = None) -> dict[str, Any]:
    """The defaults under each layer in turn. A number may be given where the default is one, else types must agree."""
    out = dict(defaults)
    for layer in layers:
        known(defaults, layer)
        for name, value in layer.items():
            base = defaults[name]
            numbers = isinstance(base, (int, float)) and not isinstance(base, bool) and isinstance(value, (int, float)) and not isinstance(value, bool)
            if base is not None and value is not None and not numbers and not isinstance(value, type(base)):
                raise TypeError(f"{name} takes {type(base).__name__}, not {value!r}")
            if bounds and name in bounds and value is not None and not bounds[name][0] <= value <= bounds[name][1]:
                raise ValueError(f"{name}={value} is outside {bounds[name]}")
            out[name] = value
    return out


def from_words(defaults: Mapping[str, Any], words: Iterable[str]) -> dict[str, Any]:
    pairs = {}
    for word in joined_words(words):
        name, mark, value = word.partition("=")
        if not mark:
            raise ValueError(f"{word} is no key=value")
        pairs[name.strip()] = typed(value)
    return merged(defaults, pairs)


def dataset_settings(given: Mapping[str, Any], split: str = "") -> dict[str, Any]:
    """A dataset's settings with ``train``, ``val``, names by class, their number ``nc`` and ``channels`` filled in.

    ``validation`` stands in for ``val``. Names or their number must be there and agree; a number may be written as text.
    """
    out = dict(given)
    if "val" not in out and "validation" in out:
        out["val"] = out.pop("validation")
    for key in ("train", "val", *([split] if split else [])):
        if key not in out or (key == split and not out[key]):
            raise KeyError(f"the dataset has no {key}")
    names, n = out.get("names"), out.get("nc")
    if names is None and n is None:
        raise KeyError("the dataset has neither names nor nc")
    if n is not None:
        try:
            if float(n) != int(float(n)):
                raise ValueError
        except (TypeError, ValueError):
            raise ValueError(f"nc={n!r} is no whole number") from None
        n = int(float(n))
    if names is None:
        names = [f"class_{i}" for i in range(n)]
    table = {int(k): str(v) for k, v in (names.items() if isinstance(names, Mapping) else enumerate(names))}
    if n is not None and len(table) != n:
        raise ValueError(f"{len(table)} names do not match nc={n}")
    if table and max(table) >= len(table):
        raise ValueError(f"class {max(table)} is out of range for {len(table)} names")
    return {**out, "names": table, "nc": len(table), "channels": out.get("channels", 3)}
