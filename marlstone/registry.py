"""Named factories: training backends, judges, samplers."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class Registry:
    """Factories by name; a name is given once."""

    def __init__(self, what: str) -> None:
        self.what = what
        self._factories: dict[str, Callable[..., Any]] = {}

    def register(self, name: str, factory: Callable[..., Any] | None = None) -> Callable[..., Any]:
        """Add a factory, directly or as a decorator."""
        if factory is None:
            return lambda own: self.register(name, own)
        if name in self._factories:
            raise ValueError(f"{self.what} {name!r} is registered already")
        self._factories[name] = factory
        return factory

    def create(self, name: str, *args: Any, **settings: Any) -> Any:
        if name not in self._factories:
            raise ValueError(f"unknown {self.what} {name!r}; known: {', '.join(self.names()) or 'none'}")
        return self._factories[name](*args, **settings)

    def names(self) -> list[str]:
        return sorted(self._factories)


backends = Registry("backend")
judges = Registry("judge")
