"""Edit paths that share their beginnings.

A path is a chain of linked steps from its last edit back to the empty path. Every step knows its 2^k-th ancestors and a rolling hash of
the whole path, so two paths of any length compare after a search for their longest common prefix in logarithmic time. Where the hashes say
that two prefixes are equal, the steps are walked back to the step both share, so a collision of hashes never decides.
"""

from __future__ import annotations

BASE, PRIME = 1_000_003, (1 << 61) - 1


class Step:
    __slots__ = ("up", "depth", "edit", "hash")

    def __init__(self, parent: Step | None, edit: str, prime: int = PRIME):
        if parent is None:
            self.up, self.depth, self.edit, self.hash = [], 0, "", 0
            return
        self.up, self.depth, self.edit = [parent], parent.depth + 1, edit
        self.hash = (parent.hash * BASE + ord(edit)) % prime
        k = 0
        while len(self.up[k].up) > k:
            self.up.append(self.up[k].up[k])
            k += 1


def lifted(step: Step, depth: int) -> Step:
    """The ancestor at a depth that is not below the step's own."""
    for k in range(len(step.up) - 1, -1, -1):
        if step.depth - (1 << k) >= depth:
            step = step.up[k]
    return step


def _first_difference(a: Step, b: Step) -> tuple[Step, Step] | None:
    """The first unlike edits of two paths of one length, walked back to the step they share."""
    found = None
    while a is not b:
        if a.edit != b.edit:
            found = (a, b)
        a, b = a.up[0], b.up[0]
    return found


def less(a: Step, b: Step) -> bool:
    """Whether the edits of a come before those of b in the order of characters."""
    short = min(a.depth, b.depth)
    x, y = lifted(a, short), lifted(b, short)
    differ = None
    if x.hash != y.hash:
        for k in range(len(x.up) - 1, -1, -1):
            if k < len(x.up) and x.up[k].hash != y.up[k].hash:
                x, y = x.up[k], y.up[k]
        differ = _first_difference(x.up[0], y.up[0]) or (x, y)
    else:
        differ = _first_difference(x, y)
    return a.depth < b.depth if differ is None else differ[0].edit < differ[1].edit


def edits(step: Step) -> str:
    out = []
    while step.up:
        out.append(step.edit)
        step = step.up[0]
    return "".join(reversed(out))
