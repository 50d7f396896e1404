"""A bounded memo of packed results for the words of a slice of rows, used inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from itertools import chain


class Memo:
    """Looks up many keys at once; ``compute`` gives the packed results of the distinct keys not yet known.

    Two generations of up to about ``entries`` keys are kept: when the younger is full the elder goes, and what is
    found in the elder moves to the younger. So frequent keys stay and memory is bounded.
    """

    def __init__(self, compute: Callable[[list], Iterable[bytes]], entries: int, length: int):
        self.compute, self.entries, self.length = compute, entries, length
        self.known: dict[Hashable, bytes] = {}
        self.elder: dict[Hashable, bytes] = {}

    def each(self, flat: list) -> list[bytes]:
        """The result of each key. Only keys up to ``length`` stay known."""
        if len(self.known) > self.entries:
            self.known, self.elder = {}, self.known
        found = list(map(self.known.get, flat))
        holes, at = [], -1
        for _ in range(found.count(None)):
            holes.append(at := found.index(None, at + 1))
        unknown = {flat[i] for i in holes}
        new = {key: self.elder[key] for key in unknown & self.elder.keys()}
        fresh = list(unknown - new.keys())
        if fresh:
            new.update(zip(fresh, self.compute(fresh), strict=True))
        for i in holes:
            found[i] = new[flat[i]]
        self.known.update((key, value) for key, value in new.items() if len(key) <= self.length)
        return found

    def joined(self, rows: list[list]) -> list[bytes]:
        """For each row of keys the joined results."""
        found = self.each(list(chain.from_iterable(rows)))
        out, at = [], 0
        for row in rows:
            out.append(b"".join(found[at : at + len(row)]))
            at += len(row)
        return out
