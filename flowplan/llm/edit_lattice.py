"""Cheapest repair of a run of turns, by Dijkstra's search from both ends of the edit lattice.

A node is (rows done, state of the role pattern ``(s?(ua)+)?``). An edge keeps, reroles or deletes the
next row or inserts one. States: 0 nothing yet, 1 after a system row, 2 after a user row, 3 after an
assistant row. Given a state every letter leads to one node, so of the cheapest repairs the one
with the least audit is found by walking only over nodes of cheapest ways.
"""

from __future__ import annotations

import heapq
from functools import lru_cache
from typing import NamedTuple

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
STATES = range(4)
#: The state after a user or assistant row put where the pattern asks for one.
PUT = (2, 2, 3, 2)
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: As a goal: the pattern is complete and nothing follows. Otherwise a goal is the state after the last row.
END = -1
_FAR = 1 << 60


class Item(NamedTuple):
    """A row, or ``forced`` neighbouring rows that have to go."""

    initial: str
    truncated: bool = False
    forced: int = 0


@lru_cache(maxsize=4096)
def _steps(item: Item, state: int) -> tuple[tuple[str, int, int], ...]:
    """(letters, cost, next state) past the item, in order of the letters."""
    if item.forced:
        return (("D" * item.forced, DELETE * item.forced, state),)
    extra = CUT if item.truncated else 0
    steps = [("D", DELETE, state)]
    if (state, item.initial) in _AFTER:
        steps.append(("K", KEEP + extra, _AFTER[state, item.initial]))
    return (*steps, ("R", REROLE + extra, PUT[state]))


@lru_cache(maxsize=4096)
def _back_steps(item: Item, state: int) -> tuple[tuple[int, int], ...]:
    """(cost, state before) of the edges past the item into ``state``."""
    return tuple((cost, before) for before in STATES for _, cost, after in _steps(item, before) if after == state)


_BACK_PUT = tuple(tuple(s for s in STATES if PUT[s] == state) for state in STATES)


class Lattice:
    """The lattice of ``items``; node i * 4 + state."""

    def __init__(self, items: list[Item], goal: int):
        self.items, self.n, self.goal = items, len(items), goal
        # Rows put in after the last row belong to what follows, so that audits of parts are never prefixes of one another.
        self.last_put = self.n + (goal == END)

    def ahead(self, node: int):
        """(letters, cost, node), letters in ASCII order: D, I, K, R."""
        i, state = divmod(node, 4)
        put = ("I", INSERT, 4 * i + PUT[state])
        if i == self.n:
            return [put] if i < self.last_put else []
        steps = [(letters, cost, 4 * (i + 1) + after) for letters, cost, after in _steps(self.items[i], state)]
        return [steps[0], put, *steps[1:]]

    def behind(self, node: int):
        """(cost, node) of the edges into ``node``."""
        i, state = divmod(node, 4)
        edges = [(INSERT, 4 * i + before) for before in _BACK_PUT[state]] if i < self.last_put else []
        if i:
            edges += [(cost, 4 * (i - 1) + before) for cost, before in _back_steps(self.items[i - 1], state)]
        return edges

    def goals(self) -> list[int]:
        return [4 * self.n + state for state in ((0, 3) if self.goal == END else (self.goal,))]


def least_repair(items: list[Item], entry: int, goal: int) -> tuple[int, str] | None:
    """Least cost from state ``entry`` to ``goal`` and, of the cheapest audits, the ASCII-least; None if there is no way."""
    net = Lattice(items, goal)
    size = 4 * (net.n + 1)
    there, back = [_FAR] * size, [_FAR] * size
    settled_there, settled_back = bytearray(size), bytearray(size)
    there[entry] = 0
    heap_there, heap_back, best, order = [(0, entry)], [], _FAR, []
    for node in net.goals():
        back[node] = 0
        heapq.heappush(heap_back, (0, node))
        best = min(best, there[node])
    # A cheapest way has all its nodes settled from one end or the other once the two tops sum to more than it costs.
    while heap_there and heap_back and heap_there[0][0] + heap_back[0][0] <= best:
        if heap_there[0][0] <= heap_back[0][0]:
            cost, node = heapq.heappop(heap_there)
            if settled_there[node]:
                continue
            settled_there[node] = 1
            order.append(node)
            for _, step, other in net.ahead(node):
                if cost + step < there[other]:
                    there[other] = cost + step
                    heapq.heappush(heap_there, (cost + step, other))
                best = min(best, cost + step + back[other])
        else:
            cost, node = heapq.heappop(heap_back)
            if settled_back[node]:
                continue
            settled_back[node] = 1
            for step, other in net.behind(node):
                if cost + step < back[other]:
                    back[other] = cost + step
                    heapq.heappush(heap_back, (cost + step, other))
                best = min(best, cost + step + there[other])
    if best >= _FAR:
        return None
    good = _before_crossings(net, there, back, settled_there, settled_back, order, best)
    return best, _walk(net, entry, there, back, good, settled_back, best)


def _before_crossings(net, there, back, settled_there, settled_back, order, best) -> bytearray:
    """Nodes from which a cheapest way goes on to an edge where the two searches meet, or to a goal not searched from."""
    good, goals = bytearray(len(there)), set(net.goals())
    todo = []
    for node in order:
        if settled_back[node]:
            continue
        if node in goals and there[node] == best or any(
            settled_back[other] and there[node] + step + back[other] == best for _, step, other in net.ahead(node)
        ):
            good[node] = 1
            todo.append(node)
    while todo:
        node = todo.pop()
        for step, other in net.behind(node):
            if settled_there[other] and not good[other] and there[other] + step == there[node]:
                good[other] = 1
                todo.append(other)
    return good


def _walk(net, node, there, back, good, settled_back, best) -> str:
    # A goal ends a cheapest way: whatever follows it costs more.
    audit, goals = [], set(net.goals())
    while node not in goals:
        for letters, step, other in net.ahead(node):
            if settled_back[node]:
                fits = settled_back[other] and back[node] == step + back[other]
            elif settled_back[other]:
                fits = there[node] + step + back[other] == best
            else:
                fits = good[other] and there[node] + step == there[other]
            if fits:
                audit.append(letters)
                node = other
                break
        else:
            raise AssertionError("no cheapest way leads on")
    return "".join(audit)


def apply(items: list[Item], audit: str, state: int):
    """(index of the item or None for a row put in, initial of the new role or '' to keep it) in the order of the audit; then the state."""
    out, at = [], 0
    for i, item in enumerate(items):
        while audit[at] == "I":
            state = PUT[state]
            out.append((None, "ua"[state - 2]))
            at += 1
        letter = audit[at]
        at += item.forced or 1
        if letter == "K":
            state = _AFTER[state, item.initial]
            out.append((i, ""))
        elif letter == "R":
            state = PUT[state]
            out.append((i, "ua"[state - 2]))
    for _ in audit[at:]:
        state = PUT[state]
        out.append((None, "ua"[state - 2]))
    return out, state
