"""The edit lattice of a conversation and its cheapest, ASCII-least path.

A node is (rows consumed, state); states: 0 nothing kept yet, 1 behind ``s``, 2 behind ``u``,
3 behind ``a``.  Legal role sequences are ``(s?(ua)+)?``, so a path may end in state 0 or 3.  Edges:
Keep (0), Rerole to the role that is due (2), Delete (3), Insert the role that is due (2); a truncated
row that stays adds 1.  A row is one symbol: its role's initial (``s``, ``u``, ``a``; ``x`` any other),
upper case if it is truncated, or ``-`` if it has to go.

``cheapest`` searches from both ends.  ``Table`` holds the cheapest path between every two states of
a run of rows; tables join end to end, so a conversation of any length may be searched in pieces.
Equal costs never leave one audit a prefix of another (the longer one would hold inserts more), so
least pieces make least wholes.
"""

from __future__ import annotations

from heapq import heappop, heappush

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
STATES, ACCEPTED = (0, 1, 2, 3), (0, 3)
#: the state behind the role that is due in each state (a user first, then turn about)
_DUE = (2, 2, 3, 2)
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_INF = float("inf")


def _edges() -> dict[str, list[list[tuple[int, int, int, str]]]]:
    """symbol -> state -> (rows, next state, cost, letter); the symbol '' stands for the end."""
    out = {}
    for symbol in ("", "-", *"suaxSUAX"):
        out[symbol] = []
        for state in STATES:
            edges = [(0, _DUE[state], 2, INSERT)]
            if symbol:
                edges.append((1, state, 3, DELETE))
            if symbol and symbol != "-":
                more = int(symbol.isupper())
                edges.append((1, _DUE[state], 2 + more, REROLE))
                kept = _KEPT.get(symbol.lower(), {}).get(state)
                if kept is not None:
                    edges.append((1, kept, more, KEEP))
            out[symbol].append(edges)
    return out


EDGES = _edges()
#: the same edges by their end: symbol -> state -> (rows, state before, cost)
_INTO = {symbol: [[(rows, before, cost) for before in STATES for rows, state, cost, _ in by[before] if state == after] for after in STATES]
         for symbol, by in EDGES.items()}


def cheapest(symbols: str, entry: int = 0, exits: tuple[int, ...] = ACCEPTED) -> tuple[int, str] | None:
    """(cost, audit) of the best path from ``entry`` before the first row to one of ``exits`` behind
    the last; None if there is none."""
    n = len(symbols)
    start, last = entry, 4 * n
    ahead, behind = {start: 0}, {last + s: 0 for s in exits}
    heap, back = [(0, start)], [(0, last + s) for s in sorted(exits)]
    best = 0 if start in behind else _INF
    done_ahead: set[int] = set()
    done_behind: set[int] = set()
    # every crossing of cost ``best`` is behind one of the two fronts once they are further apart
    while heap and back and heap[0][0] + back[0][0] <= best:
        if heap[0][0] <= back[0][0]:
            cost, node = heappop(heap)
            if node in done_ahead:
                continue
            done_ahead.add(node)
            i, state = divmod(node, 4)
            for rows, to, more, _ in EDGES[symbols[i:i + 1]][state]:
                v, c = 4 * (i + rows) + to, cost + more
                if c < ahead.get(v, _INF):
                    ahead[v] = c
                    heappush(heap, (c, v))
                    if v in behind and c + behind[v] < best:
                        best = c + behind[v]
        else:
            cost, node = heappop(back)
            if node in done_behind:
                continue
            done_behind.add(node)
            i, state = divmod(node, 4)
            into = [(0, s, c) for rows, s, c in _INTO[""][state]]
            if i:
                into += [e for e in _INTO[symbols[i - 1]][state] if e[0]]
            for rows, before, more in into:
                v, c = 4 * (i - rows) + before, cost + more
                if c < behind.get(v, _INF):
                    behind[v] = c
                    heappush(back, (c, v))
                    if v in ahead and c + ahead[v] < best:
                        best = c + ahead[v]
    if best == _INF:
        return None
    far = heap[0][0] if heap else _INF
    near = back[0][0] if back else _INF
    return int(best), _least(symbols, start, {last + s for s in exits}, best, ahead, behind, far, near)


def _least(symbols: str, start: int, ends: set[int], best: float, ahead: dict, behind: dict, far: float, near: float) -> str:
    """The ASCII-least audit among the paths of cost ``best``.  Of a node on such a path, the cost from
    the start is final below ``far`` or the cost to the end below ``near``."""
    on_path = {}

    def steps(node: int) -> list[tuple[str, int]]:
        """Edges from ``node`` that stay on a best path."""
        i, state = divmod(node, 4)
        out = []
        known = behind.get(node, _INF)
        for rows, to, more, letter in EDGES[symbols[i:i + 1]][state]:
            v = 4 * (i + rows) + to
            rest = behind.get(v, _INF)
            if known < near:
                if rest + more == known:
                    out.append((letter, v))
            elif rest < near:
                if ahead[node] + more + rest == best:
                    out.append((letter, v))
            elif on_path.get(v) and ahead[v] == ahead[node] + more:
                out.append((letter, v))
        return out

    # before the crossings: nodes from the furthest on, so that those behind them are decided
    before = sorted((v for v, c in ahead.items() if c < far and not behind.get(v, _INF) < near), key=lambda v: (-ahead[v], -v))
    for v in before:
        on_path[v] = v in ends and ahead[v] == best or bool(steps(v))
    audit, front = [], {start}
    while True:
        found: dict[str, set[int]] = {}
        for node in front:
            for letter, v in steps(node):
                found.setdefault(letter, set()).add(v)
        if not found:
            return "".join(audit)
        letter = min(found)
        audit.append(letter)
        front = found[letter]


Table = dict[tuple[int, int], tuple[int, str]]


def table(symbols: str) -> Table:
    """(entry, exit) -> (cost, audit) of a run of rows."""
    return {(s, t): got for s in STATES for t in STATES if (got := cheapest(symbols, s, (t,))) is not None}


class Path:
    """Cheapest audits of the rows so far, by state, kept as chains of pieces: tables of further rows
    are added at the end; texts are compared only where costs tie, back to the common piece."""

    def __init__(self):
        # state -> (cost, chain); a chain is (chain before, text, number of pieces)
        self.best: dict[int, tuple[int, tuple | None]] = {0: (0, None)}

    @staticmethod
    def _pieces(chain: tuple | None) -> list[tuple]:
        out = []
        while chain is not None:
            out.append(chain)
            chain = chain[0]
        return out[::-1]

    @classmethod
    def _smaller(cls, one: tuple, other: tuple) -> bool:
        a, b = one, other
        # chains of equal numbers of pieces: step back to where they part
        tail_a, tail_b = [], []
        while a is not b:
            tail_a.append(a[1])
            tail_b.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(tail_a)) < "".join(reversed(tail_b))

    def add(self, rows: Table) -> None:
        got: dict[int, tuple[int, tuple]] = {}
        for (entry, exit_), (cost, audit) in sorted(rows.items()):
            if entry not in self.best:
                continue
            before, chain = self.best[entry]
            new = (before + cost, (chain, audit))
            old = got.get(exit_)
            if old is None or new[0] < old[0] or new[0] == old[0] and self._smaller(new[1], old[1]):
                got[exit_] = new
        self.best = got

    def result(self) -> tuple[int, str]:
        ends = [(cost, "".join(p[1] for p in self._pieces(chain))) for state, (cost, chain) in self.best.items() if state in ACCEPTED]
        return min(ends)


def repaired(audit: str, roles) -> list[tuple[str, str | None, bool]]:
    """(letter, role behind the edit or None, whether it takes a row) of each edit; ``roles`` gives
    the roles of the rows in turn."""
    out, due = [], "user"
    roles = iter(roles)
    for letter in audit:
        role = next(roles) if letter != INSERT else None
        if letter == DELETE:
            out.append((letter, None, True))
            continue
        kept = role if letter == KEEP else due
        out.append((letter, kept, letter != INSERT))
        if kept[:1] != "s":
            due = "assistant" if kept[:1] == "u" else "user"
    return out
