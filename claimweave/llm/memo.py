"""A bounded memory of what a worker has computed per word."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable


class Memo:
    """Values by key in two generations, so that frequent keys outlive the bound.

    At most ``2 * limit`` entries plus those of one call are held. It only saves
    work: what it has forgotten is computed anew.
    """

    def __init__(self, limit: int, compute: Callable[[list], Iterable]):
        self.limit, self.compute = limit, compute
        self.young: dict = {}
        self.old: dict = {}

    def learn(self, keys: set[Hashable]) -> dict:
        """A table that holds every one of ``keys``."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old, new = self.young, self.old, []
        for key in keys - young.keys():
            value = old.get(key)
            if value is None:
                new.append(key)
            else:
                young[key] = value
        if new:
            young.update(zip(new, self.compute(new), strict=True))
        return young
